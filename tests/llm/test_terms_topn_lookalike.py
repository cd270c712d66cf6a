import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from weft.llm.lookalike import consistent_forms, inconsistent_values, resolved, settle
from weft.llm.termfreq import rare_or_common, term_counters
from weft.llm.topn import top_n_per_group

NAMES = "row_no bigint, business_name string, term string"


def test_counters_against_brute_force(spark):
    rnd = random.Random(3)
    words = ["a", "b", "B", "café", "É", "x"]
    data = [(i, None if i % 9 == 0 else " ".join(rnd.choices(words, k=rnd.randrange(0, 8))), "clash") for i in range(120)]
    want = {}
    for i, v, _ in data:
        toks = [] if v is None else ["".join(c.lower() if c.isascii() else c for c in t) for t in v.split(" ") if t]
        for t in toks:
            want.setdefault(t, [0, set()])[0] += 1
            want[t][1].add(i)
    got = term_counters(spark.createDataFrame(data, NAMES).repartition(5), ["business_name"], "row_no")
    assert {r.term: (r.occurrences, r.records, r.last_record) for r in got.collect()} == {t: (n, len(s), max(s)) for t, (n, s) in want.items()}


def test_a_record_spread_over_rows_and_splits_counts_once(spark):
    rnd = random.Random(4)
    data = [(rnd.choice([*range(12), None]), " ".join(["hot", *rnd.choices("abc", k=rnd.randrange(0, 4))]), "clash") for _ in range(300)]
    want = {}
    for at, (i, v, _) in enumerate(data):
        for t in v.split(" "):
            n, s = want.setdefault(t, ([], set()))
            n.append(i)
            s.add(i if i is not None else f"row {at}")
    df = spark.createDataFrame(data, NAMES)
    for splits in (1, 7):
        got = term_counters(df.repartition(splits), ["business_name"], "row_no")
        assert {r.term: (r.occurrences, r.records, r.last_record) for r in got.collect()} == {t: (len(n), len(s), max(x for x in n if x is not None)) for t, (n, s) in want.items()}
    two = spark.createDataFrame([(1, "a b", ""), (1, "a c", ""), (2, "a", "")], NAMES)
    assert {r.term: r.records for r in term_counters(two, ["business_name"], "row_no").collect()} == {"a": 2, "b": 1, "c": 1}
    assert term_counters(spark.createDataFrame([(None, "z", "")], NAMES), ["business_name"], "row_no").first().last_record is None


def test_marks(spark):
    df = spark.createDataFrame([(i, "the shop" if i else "The lone lone", "") for i in range(100)], NAMES)
    assert rows(rare_or_common(df, ["business_name"], "row_no"), "term", "mark") == [("lone", "rare"), ("shop", "common"), ("the", "common")]
    assert rare_or_common(df.limit(0), ["business_name"], "row_no").count() == 0
    blank = spark.createDataFrame([(1, "  ", ""), (2, None, ""), (3, "", ""), (None, "x" * 200000, "")], NAMES)
    assert [tuple(r)[:1] + tuple(r)[2:] for r in rare_or_common(blank, ["business_name"], "row_no").collect()] == [("business_name", "rare"), ("business_name", "common")]


def test_top_n(spark):
    nan = float("nan")
    data = [("g", "S2-9", 1.0), ("g", "S3-1", 1.0), ("g", "S2-10", 1.0), ("g", "S2-10", 0.5), ("g", "S3-7", nan), ("g", "S3-8", None), ("h", "odd", 0.1), ("h", "S2-1", 0.1), (None, "S2-1", 9.0), ("h", None, 9.0)]
    df = spark.createDataFrame(data, "s1_id string, target_id string, rank_score double")
    got = [(r.s1_id, r.target_id, r["rank"]) for r in top_n_per_group(df, "s1_id", "target_id", "rank_score", 2).collect()]
    assert sorted(got) == [("g", "S2-10", 2), ("g", "S3-1", 1), ("h", "S2-1", 1), ("h", "odd", 2)]
    assert top_n_per_group(df.limit(0), "s1_id", "target_id", "rank_score", 2).count() == 0


def test_top_n_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("g", "S2-9", 1.0)], "s1_id string, target_id string, rank_score double")
    plan = top_n_per_group(df, "s1_id", "target_id", "rank_score", 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize(
    "value,form,faults",
    [
        ("Gosavi Cafe", "Gosavi Cafe", []),
        ("Café  BAR", "Café  BAR", []),
        ("Москва", "Москва", []),
        ("Cаfe", "Cafe", ["mixed_script"]),
        ("Моsква", "Моѕква", ["mixed_script"]),
        ("Café", "Café", ["loose_accent"]),
        ("Go​savi Cafe", "Gosavi Cafe", ["blank", "unseen"]),
        ("ＡＢ　ﬁn", "AB fin", ["blank", "variant"]),
        ("\U0001d406o", "Go", ["variant"]),
        ("U‑ 4", "U- 4", ["variant"]),
        ("Ἀ", "Ἀ", []),
        ("", "", []),
        ("a\tb", "a b", ["blank"]),
    ],
)
def test_settle(value, form, faults):
    assert settle(value)[:2] == (form, faults)


def test_script_sets():
    assert resolved("12") == {"*"} and not resolved("aб") and "Latin" in resolved("a1")
    assert settle("сосо Bar Cafe")[2] and settle("сосо Bar Cafe", respell_whole=True)[0] == "coco Bar Cafe"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=25))
def test_settle_is_stable(value):
    form, _, _ = settle(value)
    assert settle(form)[0] == form


def test_inconsistent_values(spark):
    df = spark.createDataFrame([(1, "Cаfe", "x"), (2, None, " "), (3, "ok", ""), (3, "ok", "")], "row_no bigint, business_name string, business_address string")
    df = df.withColumnRenamed("business_address", "value").withColumnRenamed("value", "business_address")
    assert rows(inconsistent_values(df, "row_no", ["business_name", "business_address"]), "row_no", "field") == [(1, "business_name"), (2, "business_address")]
    assert consistent_forms(df.limit(0), "row_no", ["business_name"]).count() == 0
