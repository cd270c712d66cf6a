"""The language of every document and of every paragraph or stretch in another language.

Method: the script of a word narrows its candidates (a Cyrillic word can only be of a language whose
samples are in Cyrillic, a word of a script without samples of none). A word's score in each candidate comes
from a model trained on trusted samples, its frequency there interpolated with a character model, so that
unseen words are scored as well. One more state stands for what is no language; its score is a uniform
character model, which beats the trained ones on gibberish. Viterbi with a penalty for switching then
labels the words of the document's running text, from its first word to its last whatever its length.

A document's language is the label of most of its labelled words, a paragraph's likewise; a span is a run
of words inside a paragraph with another label than the paragraph's. The confidence is the share of the
words with that label times the posterior of the summed scores.

Training reads at most ``max_samples`` rows of the samples, in order of their ids; all documents are
labelled over their whole texts.

Defined results
    * null, empty and text-free documents get no rows; ids may be null or repeated;
    * running text excludes templates, tables, lists, headings, references and category links; a link
      in a sentence counts by its label;
    * a paragraph made of few different words is no running text: fewer than a quarter of its words, or
      fewer than ``VARIED`` where it is long;
    * an empty sample or document table gives no rows;
    * other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.markup import paragraphs, running_text
from weft.session import ship

MAX_SAMPLES = 20_000
#: different words from which a long paragraph is varied enough to be running text
VARIED = 50
#: shortest running text of a paragraph and of a document that is judged
MIN_PARAGRAPH, MIN_DOCUMENT = 8, 15
#: shortest run of words inside a paragraph that is reported
MIN_SPAN = 5
SWITCH = 8.0
CLIP = 6.0
NONE_PER_CHAR = math.log(1 / 32)

# Notations of the six languages.
NOTATIONS = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "ru": ("ru", "rus", "russian", "русский"),
}
NO_LANGUAGE = ("", "und", "zxx", "mul", "mis", "unk", "unknown", "none", "null", "nan", "na", "n/a", "xx", "other")

_WORDS = re.compile(r"[^\W\d_]+")
_ALNUM = re.compile(r"[^\W_]").search
#: script ranges that narrow the candidates; a word in none of them is of no language
SCRIPTS = {"Cyrillic": re.compile(r"[Ѐ-ԯ]"), "Greek": re.compile(r"[Ͱ-Ͽἀ-῿]"), "Hebrew": re.compile(r"[֐-׿]"), "Arabic": re.compile(r"[؀-ۿݐ-ݿ]"), "Latin": re.compile(r"[a-zª-ɏḀ-ỿ]")}


def script_of(word: str) -> str:
    return next((name for name, letters in SCRIPTS.items() if letters.search(word)), "")


def named_language(label: Column) -> Column:
    """The code a label names, in any notation; '?' for another language; null for none."""
    plain = F.lower(F.trim(F.regexp_replace(label, r"\s+", " ")))
    first = F.when(plain.isin(*NO_LANGUAGE) | ~plain.rlike(r"\p{L}"), None).otherwise(F.split(plain, "[-_. ]", 2)[0])
    out = F.when(first.isNull() | first.isin(*NO_LANGUAGE), None)
    for code, names in NOTATIONS.items():
        out = out.when(first.isin(*names), F.lit(code))
    return out.otherwise(F.lit("?"))


class WordModel:
    """Scores of lower-case words in each language and, last, in no language."""

    ORDER = 4

    def __init__(self, samples: Iterable[tuple[str, str]]):
        words: dict[str, Counter] = defaultdict(Counter)
        for lang, text in samples:
            if lang and text:
                words[lang].update(_WORDS.findall(running_text(text).lower()))
        self.langs = sorted(words)
        self.words = {lang: dict(words[lang]) for lang in self.langs}
        self.total = {lang: sum(words[lang].values()) for lang in self.langs}
        self.grams = {lang: self._grams(words[lang]) for lang in self.langs}
        self.script = {lang: self._main_script(words[lang]) for lang in self.langs}
        self.alphabet = {s: len({c for lang in self.langs if self.script[lang] == s for w in words[lang] for c in w}) + 2 for s in set(self.script.values())}

    @staticmethod
    def _main_script(words: Counter) -> str:
        seen: Counter = Counter()
        for w, n in words.items():
            seen[script_of(w)] += n
        return max(sorted(seen), key=seen.get)

    def _grams(self, words: Counter) -> list[dict[str, Counter]]:
        out: list[dict[str, Counter]] = [defaultdict(Counter) for _ in range(self.ORDER)]
        for w in words:  # each word once: the character model is about how words look
            s = "^" * (self.ORDER - 1) + w + "$"
            for i in range(self.ORDER - 1, len(s)):
                for k in range(self.ORDER):
                    out[k][s[i - k : i]][s[i]] += 1
        return [{h: (sum(c.values()), len(c), dict(c)) for h, c in level.items()} for level in out]

    def _spelled(self, lang: str, word: str) -> float:
        """Log probability of the spelling, Witten-Bell interpolated."""
        base, levels, out = 1 / self.alphabet[self.script[lang]], self.grams[lang], 0.0
        s = "^" * (self.ORDER - 1) + word + "$"
        for i in range(self.ORDER - 1, len(s)):
            p = base
            for k in range(self.ORDER):
                seen = levels[k].get(s[i - k : i])
                if seen is None:
                    break
                n, kinds, follow = seen
                p = (follow.get(s[i], 0) + kinds * p) / (n + kinds)
            out += math.log(p)
        return out

    def scores(self, word: str) -> np.ndarray:
        """Log scores per language and for no language, the best being 0; at least -CLIP."""
        script = script_of(word)
        out = []
        for lang in self.langs:
            if self.script[lang] != script:
                out.append(-1e9)
                continue
            spelled, seen = math.log(0.3) + self._spelled(lang, word), self.words[lang].get(word, 0)
            out.append(math.log(0.7 * seen / self.total[lang] + math.exp(spelled)) if seen else spelled)
        out.append(NONE_PER_CHAR * (len(word) + 1))
        a = np.array(out)
        return np.maximum(a - a.max(), -CLIP)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best labels of many sequences at once. scores: (words, states), sequences one after another.

    All sequences take a step together; the tables have a row per word.
    """
    n, states = len(lengths), scores.shape[1]
    labels = np.zeros(len(scores), np.int8)
    if not n or not len(scores):
        return labels
    order = np.argsort(-lengths, kind="stable")
    lengths, starts = lengths[order], (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
    offset = np.concatenate(([0], np.cumsum(active)))  # of step t in the tables
    came, stayed = np.zeros(offset[-1], np.int8), np.zeros((offset[-1], states), bool)
    best = scores[starts[: active[0]]].astype(np.float32)
    for t in range(1, longest):
        m = active[t]
        old = best[:m]
        top = old.argmax(1).astype(np.int8)
        over = old[np.arange(m), top] - switch
        keep = old >= over[:, None]
        came[offset[t] : offset[t + 1]], stayed[offset[t] : offset[t + 1]] = top, keep
        best[:m] = np.where(keep, old - over[:, None], 0) + scores[starts[:m] + t]  # relative to the best, so that long texts don't wear out the floats
    state = best.argmax(1).astype(np.int8)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        labels[starts[:m] + t] = state[:m]
        if t:
            now = state[:m]
            state[:m] = np.where(stayed[offset[t] + np.arange(m), now], now, came[offset[t] : offset[t + 1]])
    return labels


def _paragraphs(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Number, size in words and the scored words of each paragraph of running text."""
    for number, part in enumerate(paragraphs(text.lower()), 1):
        words = _WORDS.findall(part)
        if not words:
            continue
        if len(words) >= MIN_PARAGRAPH and len(set(words)) < min(len(words) / 4, VARIED):
            continue
        yield number, sum(1 for x in part.split() if _ALNUM(x)), words


def language_segments(docs: DataFrame, key: str, text: str, samples: DataFrame, *, sample_key: str = "sample_id", sample_lang: str = "lang", sample_text: str = "text", switch: float = SWITCH, max_samples: int = MAX_SAMPLES) -> DataFrame:
    """key, seg_no, first_word, lang, confidence, words.

    seg_no 0 is the document (if it has MIN_PARAGRAPH words of running text), others are paragraphs of at
    least MIN_PARAGRAPH words in another language; both have first_word 0. Where first_word is not 0, the row
    is a span of MIN_SPAN words or more inside paragraph seg_no, from that of its words (letters only) on, in
    another language than the paragraph's.
    """
    ship(docs.sparkSession)
    trusted = samples.orderBy(sample_key).limit(max_samples).select(sample_lang, sample_text).collect()
    model = WordModel([(r[0], r[1]) for r in trusted])
    key_type = docs.schema[key].dataType.simpleString()
    none = len(model.langs)
    schema = f"`{key}` {key_type}, seg_no int, first_word int, lang string, confidence double, words int"
    if not none:
        return docs.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        table = np.empty((1 << 14, none + 1), np.float32)

        def word_id(w: str) -> int:
            nonlocal table
            i = known.get(w)
            if i is None:
                i = known[w] = len(known)
                if i == len(table):
                    table = np.concatenate((table, np.empty_like(table)))
                table[i] = model.scores(w)
            return i

        for whole in batches:
            for at in range(0, whole.num_rows, 4000):
                b = whole.slice(at, 4000)
                if len(known) > 400_000:
                    known.clear()  # scores are made anew as words come again
                ids: list[int] = []
                rows, numbers, sizes, counts = [], [], [], []
                for i, value in enumerate(b.column(1).to_pylist()):
                    if not value:
                        continue
                    for number, size, words in _paragraphs(value):
                        try:
                            ids.extend([known[w] for w in words])
                        except KeyError:
                            ids.extend([word_id(w) for w in words])
                        rows.append(i)
                        numbers.append(number)
                        sizes.append(size)
                        counts.append(len(words))
                if not ids:
                    continue
                yield judged(b.column(0), np.array(ids), np.array(rows), np.array(numbers), np.array(sizes), np.array(counts), table)

    def judged(keys: pa.Array, ids: np.ndarray, rows: np.ndarray, numbers: np.ndarray, sizes: np.ndarray, counts: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
        scores = table[ids]
        per_doc = np.bincount(rows, weights=counts).astype(np.int64)
        per_doc = per_doc[per_doc > 0]
        labels = viterbi(scores, per_doc, switch)
        para = np.repeat(np.arange(len(counts)), counts)
        votes = np.zeros((len(counts), none + 1))
        np.add.at(votes, (para, labels), 1)
        sums = np.add.reduceat(scores[:, :none].astype(np.float64), np.cumsum(counts) - counts, axis=0)
        of_lang = votes[:, :none]
        # a paragraph that is mostly no language is no running text
        prose = of_lang.sum(1) * 2 > counts
        docs_n = int(rows.max()) + 1
        doc_votes, doc_sums, doc_size, doc_words = np.zeros((docs_n, none)), np.zeros((docs_n, none)), np.zeros(docs_n, np.int64), np.zeros(docs_n, np.int64)
        np.add.at(doc_votes, rows[prose], of_lang[prose])
        np.add.at(doc_sums, rows[prose], sums[prose])
        np.add.at(doc_size, rows[prose], sizes[prose])
        np.add.at(doc_words, rows[prose], counts[prose])

        def sure(v: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            best = v.argmax(1)
            e = np.exp(s - s.max(1, keepdims=True))
            at = np.arange(len(best))
            return best, e[at, best] / e.sum(1) * v[at, best] / np.maximum(n, 1)

        main, main_sure = sure(doc_votes, doc_sums, doc_words)
        own, own_sure = sure(of_lang, sums, counts)
        d = np.flatnonzero(doc_size >= MIN_PARAGRAPH)
        p = np.flatnonzero(prose & (sizes >= MIN_PARAGRAPH) & (own != main[rows]) & (of_lang.max(1) * 2 > counts))
        # runs of one label inside a paragraph that isn't the paragraph's
        begins = np.flatnonzero(np.concatenate(([True], (labels[1:] != labels[:-1]) | (para[1:] != para[:-1]))))
        runs, of, label = np.diff(np.append(begins, len(labels))), para[begins], labels[begins]
        r = np.flatnonzero((label < none) & (runs >= MIN_SPAN) & prose[of] & (label != own[of]))
        span_sums = np.add.reduceat(scores[:, :none].astype(np.float64), begins, axis=0)[r] if len(r) else np.zeros((0, none))
        span_best, span_sure = sure(np.eye(none)[label[r]] * runs[r, None], span_sums, runs[r]) if len(r) else (label[r], np.zeros(0))
        first = begins[r] - (np.cumsum(counts) - counts)[of[r]] + 1
        langs = np.array(model.langs)
        take = np.concatenate((d, rows[p], rows[of[r]]))
        seg = np.concatenate((np.zeros(len(d), np.int64), numbers[p], numbers[of[r]]))
        at = np.concatenate((np.zeros(len(d) + len(p), np.int64), first))
        lang = np.concatenate((langs[main[d]], langs[own[p]], langs[span_best]))
        certain = np.concatenate((main_sure[d], own_sure[p], span_sure))
        words = np.concatenate((doc_size[d], sizes[p], runs[r]))
        cols = [keys.take(pa.array(take)), pa.array(seg, pa.int32()), pa.array(at, pa.int32()), pa.array(lang, pa.string()), pa.array(np.round(certain, 6)), pa.array(words, pa.int32())]
        return pa.RecordBatch.from_arrays(cols, [key, "seg_no", "first_word", "lang", "confidence", "words"])

    return docs.select(F.col(key), F.col(text).cast("string").alias("_weft_text")).mapInArrow(run, schema)


def mislabelled(docs: DataFrame, key: str, text: str, label: str, samples: DataFrame, **kw) -> DataFrame:
    """key, seg_no, lang, confidence: documents labelled wrongly or not at all, and foreign paragraphs.

    The label travels with the text, so nothing is shuffled.
    """
    tagged = docs.select(F.struct(F.col(key).alias("k"), named_language(F.col(label)).alias("named")).alias("_weft_key"), F.col(text).alias("_weft_body"))
    found = language_segments(tagged, "_weft_key", "_weft_body", samples, **kw)
    wrong = (F.col("first_word") == 0) & ((F.col("seg_no") > 0) | ((F.col("words") >= MIN_DOCUMENT) & ~F.col("_weft_key.named").eqNullSafe(F.col("lang"))))
    return found.where(wrong).select(F.col("_weft_key.k").alias(key), "seg_no", "lang", "confidence")
