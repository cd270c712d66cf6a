import json
import os

import numpy as np
import pytest

from tests.conftest import rows
from weft.llm.catalog import BYTE_BPE_50K, TOKENIZERS
from weft.llm.language import WordModel, language_segments, mislabelled, named_language, viterbi
from weft.llm.leakage import PASSAGE, leaked_items, longest_stretch, plausible, string_tiles, text_words
from weft.llm.markup import paragraphs, running_text
from weft.llm.tokenize import decode_corpus, encode_corpus, token_bytes

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, ids string"
needs_vocabulary = pytest.mark.skipif(not os.path.exists(BYTE_BPE_50K), reason="no public vocabulary here")


@needs_vocabulary
@pytest.mark.parametrize("block_chars", [1, 50, 10**9])
def test_ids_equal_the_tokenizers_own(spark, block_chars):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE_50K)
    t.encode_special_tokens = True
    texts = [None, "", " ", "a", "It's  the\n\n end.\t", "<|endoftext|> x", "Ünï 👍🏽 кот 漢字 123456", "don't'll''s", "x" * 30000, " w​i", "a", None]
    df = spark.createDataFrame([(i % 9, s, "clash") for i, s in enumerate(texts)], DOCS).repartition(3)
    got = sorted((r.doc_id, tuple(r.ids)) for r in encode_corpus(df, "doc_id", "text", BYTE_BPE_50K, block_chars=block_chars).collect())
    assert got == sorted((i % 9, tuple(t.encode(s or "", add_special_tokens=False).ids)) for i, s in enumerate(texts))
    assert encode_corpus(df.limit(0), "doc_id", "text", BYTE_BPE_50K).count() == 0


@needs_vocabulary
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_round_trip_of_whole_documents(spark, name):
    path = f"{TOKENIZERS}/{name}"
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    back = decode_corpus(encode_corpus(docs, "doc_id", "text", path), "doc_id", "ids", path)
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text or "" for r in docs.collect()}


@needs_vocabulary
def test_token_table():
    with open(BYTE_BPE_50K, encoding="utf-8") as f:
        n = len(json.load(f)["model"]["vocab"])
    table = token_bytes(BYTE_BPE_50K)
    assert len(table) == n and {table[i].as_py() for i in range(256)} == {bytes([i]) for i in range(256)}


@needs_vocabulary
def test_words_as_the_vocabulary_has_them(spark):
    from tokenizers import Tokenizer

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    t = Tokenizer.from_file(path)
    texts = ["It's  THE\n\n end.", "Cafe\u0301 ÄÖ 123", "", None, "漢字 don't'll", " x" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.ids for r in encode_corpus(df, "doc_id", "text", path).collect()}
    assert got == {i: t.encode(s or "", add_special_tokens=False).ids for i, s in enumerate(texts)}
    with pytest.raises(ValueError):
        decode_corpus(df.selectExpr("doc_id", "array(1) AS ids"), "doc_id", "ids", path)


@needs_vocabulary
@pytest.mark.parametrize("block_ids", [1, 7, 10**6])
def test_decoding_in_blocks(spark, block_ids):
    texts = {1: "Ünï 👍🏽 кот", 2: "", 3: "a" * 5000, 4: "x y z", 5: "👍"}
    df = encode_corpus(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), "doc_id", "text", BYTE_BPE_50K)
    more = df.unionByName(spark.createDataFrame([(6, None), (7, [10**8])], df.schema))
    got = {r.doc_id: r.text for r in decode_corpus(more, "doc_id", "ids", BYTE_BPE_50K, block_ids=block_ids).collect()}
    assert got == {**texts, 6: None, 7: ""}
    assert decode_corpus(df.limit(0), "doc_id", "ids", BYTE_BPE_50K).count() == 0


def test_decoding_nulls_and_stray_bytes(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [64])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.text for r in decode_corpus(df, "doc_id", "ids", BYTE_BPE_50K).collect()}
    assert got[1] is None and got[2] == "" and len(got[3]) == 1


def test_running_text_keeps_paragraph_numbers():
    text = "{{Box\n| a = {{n:1}}\n\n| b = 2\n}}\n\n'''A''' is [[B|b]]&nbsp;c.<ref>{{x|1}}</ref>\n\n{|\n! h\n\n|-\n|}\n\n* [[x]]\n== H ==\nend [[Category:Z]]"
    parts = [p.split() for p in paragraphs(text)]
    assert parts == [[], [], ["A", "is", "b", "c."], [], [], ["end"]]
    assert [p.split() for p in paragraphs("a\n* x\nb\n\n\n\n[[Category:Z]]\nc\n\n\nd")] == [["a", "b"], [], ["c"], ["d"]]
    assert running_text("* [[a|b]] {{c}}", lines=False).split() == ["*", "b"]


SAMPLES = [
    (1, "en", "The old harbour replaced a line of wooden houses around the square after the great flood. It is not known who built the tower near the gate."),
    (2, "de", "Der alte Hafen ersetzte eine Reihe hölzerner Häuser rund um den Platz nach der großen Flut. Wer den Turm am Tor baute, ist nicht bekannt."),
    (3, "ru", "Старый порт заменил ряд деревянных домов вокруг площади после большого наводнения. Неизвестно, кто построил башню у ворот."),
]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(SAMPLES, "sample_id bigint, lang string, text string")


def test_viterbi_against_brute_force():
    from itertools import product

    rnd = np.random.default_rng(1)
    for _ in range(30):
        lengths = rnd.integers(1, 6, size=4)
        scores = rnd.normal(size=(lengths.sum(), 3))
        got, at = viterbi(scores, lengths, 1.5), 0
        for n in lengths:
            value = lambda p: sum(scores[at + i, s] for i, s in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
            assert abs(value(got[at : at + n]) - max(map(value, product(range(3), repeat=int(n))))) < 1e-5
            at += n


def test_long_texts_are_decoded_whole():
    """Against a plain decoder, on a text of 20,000 words whose labels hang on one another."""
    rnd = np.random.default_rng(5)
    scores, switch = rnd.normal(size=(20_000, 4)).astype(np.float32), 3.0
    best, back = scores[0].astype(np.float64), []
    for t in range(1, len(scores)):
        top = int(best.argmax())
        stay = best >= best[top] - switch
        back.append([s if stay[s] else top for s in range(4)])
        best = np.where(stay, best, best[top] - switch) + scores[t]
    path = [int(best.argmax())]
    for b in back[::-1]:
        path.append(b[path[-1]])
    value = lambda p: scores[np.arange(len(p)), p].sum(dtype=np.float64) - switch * (np.diff(p) != 0).sum()
    got = viterbi(np.concatenate((scores, scores[:7])), np.array([20_000, 7]), switch)
    assert value(got[:20_000]) == pytest.approx(value(np.array(path[::-1])), rel=1e-6)


def test_spans_inside_a_paragraph(spark, samples):
    en = "the old harbour replaced a line of wooden houses around the square after the great flood of the year"
    de = "der alte Hafen ersetzte eine Reihe hölzerner Häuser rund um den Platz"
    df = spark.createDataFrame([(1, f"{en} {de} {en}"), (2, en)], "doc_id bigint, text string")
    got = language_segments(df, "doc_id", "text", samples)
    assert rows(got, "doc_id", "seg_no", "first_word", "lang", "words") == [(1, 0, 0, "en", 50), (1, 1, 20, "de", 12), (2, 0, 0, "en", 19)]


def test_words_and_scripts():
    m = WordModel([(lang, t) for _, lang, t in SAMPLES])
    best = lambda w: [*m.langs, "none"][int(m.scores(w).argmax())]
    assert [best(w) for w in ("flood", "häuser", "порт", "漢字", "xqzkvv")] == ["en", "de", "ru", "none", "none"]
    assert m.scores("y" * 50000).argmax() == len(m.langs)


def test_labels(spark):
    names = ["EN", "en-GB", "deu", " Deutsch ", "rus", "it", "und", "", "??", None, "pt_BR"]
    df = spark.createDataFrame([(x,) for x in names], "x string")
    assert [r[0] for r in df.select(named_language(df.x)).collect()] == ["en", "en", "de", "de", "ru", "?", None, None, None, None, "pt"]


def test_mislabelled_documents_and_paragraphs(spark, samples):
    en = "The old harbour replaced a line of wooden houses around the square after the great flood of the year."
    de = "Der alte Hafen ersetzte eine Reihe hölzerner Häuser rund um den Platz nach der großen Flut."
    ru = "Старый порт заменил ряд деревянных домов вокруг площади после большого наводнения."
    docs = [(1, f"{en}\n\n{de}\n\n{en}", "en", "x"), (2, de + " " + de, "en", "x"), (3, de + " " + de, None, "x"), (4, "lol " * 40, None, "x"), (5, None, None, "x"), (6, "", "en", "x"), (7, f"{en}\n\n* {de}", "eng", "x"), (8, "old harbour", "??", "x"), (9, f"{en}\n\n{en}\n\n\n\n{ru}", "EN", "x"), (2, de + " " + de, "en", "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, confidence string")
    got = mislabelled(df, "doc_id", "text", "lang", samples).select("doc_id", "seg_no", "lang").distinct()
    assert rows(got, "doc_id", "seg_no", "lang") == [(1, 2, "de"), (2, 0, "de"), (3, 0, "de"), (9, 4, "ru")]
    sure = language_segments(df, "doc_id", "text", samples)
    assert all(0.5 < r.confidence <= 1 for r in sure.collect())
    assert mislabelled(df.limit(0), "doc_id", "text", "lang", samples).count() == 0
    assert language_segments(df, "doc_id", "text", samples.limit(0)).count() == 0


def test_tiles_don_t_overlap_and_follow_reordering():
    a, b = list(range(1, 21)), [*range(11, 21), 99, *range(1, 11)]
    assert sorted(string_tiles(a, b)) == [(0, 11, 10), (10, 0, 10)]
    assert string_tiles([1, 2, 3], [0, 0, 0]) == [] and string_tiles([0, 0, 0], [0, 0, 0]) == []
    rnd = np.random.default_rng(2)
    for _ in range(40):
        x, y = rnd.integers(1, 5, 30).tolist(), rnd.integers(1, 5, 40).tolist()
        tiles = string_tiles(x, y)
        for i, j, n in tiles:
            assert n >= 3 and x[i : i + n] == y[j : j + n]
        for k in (0, 1):
            used = [p for t in tiles for p in range(t[k], t[k] + t[2])]
            assert len(used) == len(set(used))


def test_longest_stretch():
    item = list(range(1, 41))
    edited = [*item[:10], 99, *item[11:25], 98, *item[25:]]
    assert longest_stretch(item, edited) == 40
    assert longest_stretch(item, item[5:30]) == 25
    assert longest_stretch(item, [0] * 30) == 0


ITEM = "A school of clockmakers described the first survey of the marshes, as Lavuba Zutome noted, until the winter of 1630. Sipuke Soralu overlooked many workshops, as Pokopudi Rere noted, at the end of the century."


def test_leaks(spark):
    words = ITEM.split()
    half = " ".join(words[: len(words) // 2 + 2])
    short = " ".join(words[: len(words) // 3])
    changed = " ".join("zzz" if i % 9 == 4 else w for i, w in enumerate(words))
    markup = " ".join(f"[[X|{w}]]" if i % 5 == 0 else w.upper() for i, w in enumerate(words))
    other = "The first survey of the marshes was long. At the end of the century, many workshops closed until the winter of 1630."
    docs = [(1, f"Before. {half} after"), (2, short), (3, f"x {changed} y"), (4, markup), (5, other), (6, None), (7, ""), (8, "a b " * 20000 + ITEM), (None, ITEM), (1, f"Before. {half} after")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("clash"))
    items = spark.createDataFrame([(10, ITEM, "s"), (11, None, "s"), (12, "too short", "s")], "item_id bigint, text string, suite string")
    found = quoted(leaked_items(df, "doc_id", "text", items, "item_id", "text")).select("doc_id", "item_id").distinct()
    assert rows(found, "doc_id", "item_id") == [(1, 10), (3, 10), (4, 10), (8, 10), (None, 10)]
    assert leaked_items(df, "doc_id", "text", items.limit(0), "item_id", "text").count() == 0
    assert leaked_items(df.limit(0), "doc_id", "text", items, "item_id", "text").count() == 0


def quoted(df):
    return df.where("stretch >= wanted")


def test_reordered_passages_are_leaks_but_no_quotations(spark):
    words = ITEM.split()
    n = len(words)
    quarters = [words[i * n // 4 : (i + 1) * n // 4] for i in range(4)]
    docs = [(1, "so " * 30 + " ".join(w for q in quarters[::-1] for w in q) + " end" * 30), (2, " ".join(quarters[2])), (3, " ".join(sorted(words)))]
    items = spark.createDataFrame([(10, ITEM)], "item_id bigint, text string")
    got = leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", items, "item_id", "text").collect()
    assert [(r.doc_id, r.coverage) for r in got] == [(1, 1.0)] and got[0].stretch < got[0].wanted


def test_plausible_places_of_any_size():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        n, m = rnd.integers(1, 40), rnd.integers(1, 60)
        item, place = rnd.integers(1, 4, n), rnd.integers(0, 4, m)
        wanted = max(1, (n + 1) // 2)
        tiles = string_tiles(item.tolist(), place.tolist(), min(PASSAGE, int(n)))
        if sum(t[2] for t in tiles) >= wanted or longest_stretch(item.tolist(), place.tolist(), 8, 1) >= wanted + 1:
            assert plausible(item, place, wanted, 2)


def test_short_items(spark):
    items = [(1, "six words stand here for good"), (2, "Only three words"), (3, "two words"), (4, "word"), (5, "-- !"), (6, "five more words are here"), (7, "")]
    docs = [(1, "And so six words, stand here for good."), (2, "only three words"), (3, "in two words"), (4, "wording"), (5, "six words stand"), (6, "stand for words"), (7, "a Word")]
    found = leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text", spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text")
    assert rows(quoted(found), "doc_id", "item_id") == [(1, 1), (2, 2), (3, 3), (5, 1), (7, 4)]


def test_passes_give_the_same_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{DATA}/eval_items.parquet").select("item_id", "text")
    once = rows(leaked_items(docs, "doc_id", "text", items, "item_id", "text"), "doc_id", "item_id", "coverage", "stretch")
    assert rows(leaked_items(docs, "doc_id", "text", items, "item_id", "text", most_words=1500), "doc_id", "item_id", "coverage", "stretch") == once and once


def test_leaks_against_all_pairs(spark):
    """Every pair of the small tables decided by the exact check alone."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{DATA}/eval_items.parquet").select("item_id", "text")
    got = {(r.doc_id, r.item_id) for r in quoted(leaked_items(docs, "doc_id", "text", items, "item_id", "text")).collect()}
    known: dict[str, int] = {}
    ids = lambda t: [known.setdefault(w, len(known) + 1) for w in text_words(t or "")]
    wanted, it = set(), [(r.item_id, ids(r.text)) for r in items.collect()]
    for r in docs.collect():
        d = ids(r.text)
        for i, x in it:
            if len(set(x) & set(d)) * 3 > len(set(x)) and longest_stretch(x, d) * 2 >= len(x):
                wanted.add((r.doc_id, i))
    assert got == wanted
