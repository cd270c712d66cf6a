import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weft.operators.treeagg import count_chunks, heavy_values, tree_aggregate, tree_levels, tree_shape, value_profile

SCHEMA = "country string, business_name string, recorded_at timestamp, n_rows int"


def test_shape_of_the_tree():
    assert [tree_shape(n, 2) for n in (1, 2, 4, 5, 8, 9)] == [(2, 2), (2, 2), (2, 2), (3, 2), (3, 2), (4, 2)]
    for fan_in in (2, 3, 7, 32):
        for n in (1, 2, 3, 6, 12, 33, 1000, 1024, 1025, 800_000):
            rounds, fan = tree_shape(n, fan_in)
            assert 2 <= fan <= fan_in and fan**rounds >= n and rounds >= 2 and (rounds == 2 or fan_in ** (rounds - 1) < n)


def test_no_merge_gets_more_states_of_a_key_than_fan_in(spark):
    """A key in every row: its states per node, before and after each round."""
    df = spark.range(0, 5000, 1, 20).select(F.lit("hot").alias("k"), (F.col("id") % 7).alias("v"))
    assert count_chunks(df, 64) == (20, 4)
    levels = tree_levels(df, ["k"], [("n", "count", F.lit(1))], fan_in=4, chunk_rows=64)
    sizes = [level.groupBy("k").agg(F.count(F.lit(1)).alias("states"), F.sum("n").alias("n")).first() for level in levels]
    assert all(r.n == 5000 for r in sizes) and sizes[-1].states == 1
    assert [r.states for r in sizes] == [27, 9, 3, 1]  # 80 chunks, three to a node
    assert all(4 * b.states >= a.states for a, b in zip(sizes, sizes[1:]))


def test_more_splits_than_counted_are_still_one_row(spark):
    df = spark.range(0, 100, 1, 16).select((F.col("id") % 3).alias("k"))
    got = tree_aggregate(df, ["k"], [("n", "count", F.lit(1))], fan_in=2, chunks=(2, 1)).collect()
    assert sorted((r.k, r.n) for r in got) == [(0, 34), (1, 33), (2, 33)]


@pytest.mark.parametrize("fan_in,chunk_rows,chunks", [(2, 4, None), (4, 1, None), (32, 1024, None), (2, 4, (64, 64))])
def test_same_as_plain_count_whatever_the_tree(spark, fan_in, chunk_rows, chunks):
    rnd = random.Random(1)
    keys = [rnd.choice(["hot"] * 6 + ["a", "b", None, "", f"k{rnd.randrange(50)}"]) for _ in range(700)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int").repartition(7)
    got = tree_aggregate(df, ["k"], [("n", "count", F.lit(1)), ("lo", "min", F.col("v")), ("s", "sum", F.col("v"))], fan_in=fan_in, chunk_rows=chunk_rows, chunks=chunks)
    assert {r.k: r.n for r in got.collect()} == dict(Counter(keys))
    first = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    assert {r.k: r.lo for r in got.collect()} == first


def test_profile_and_heavy_values(spark):
    data = [("US", "Shop", None, 1)] * 60 + [("us", None, None, 1)] * 3 + [(None, f"n{i}", None, 2) for i in range(37)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(heavy_values(df, ["country", "business_name"], fan_in=2, chunk_rows=4), "field", "key_value") == [("business_name", "Shop"), ("country", "US"), ("country", "us")]
    prof = {(r.field, r.key_value): r.n_rows for r in value_profile(df, ["country"]).collect()}
    assert prof == {("country", "US"): 60, ("country", "us"): 3, ("country", None): 37}


def test_exactly_one_in_fifty_is_not_heavy_and_empty_table(spark):
    df = spark.createDataFrame([("a",)] * 1 + [(f"x{i}",) for i in range(49)], "country string")
    assert heavy_values(df, ["country"]).count() == 0
    assert heavy_values(df.limit(0), ["country"]).count() == 0
