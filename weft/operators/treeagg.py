"""Per-key aggregation in a tree, for keys of which a few hold most rows.

A plain ``groupBy(key)`` sends one partial state per task and key to one reducer; with a hundred
thousand tasks the reducer of a key that occurs everywhere merges a hundred thousand states. Here the
rows are numbered in chunks of fixed size that never cross an input split, every chunk is combined
locally (Spark's map-side partial aggregation), and the states then climb a balanced tree: a round merges
the states of ``fan`` neighbouring nodes into one, so no reducer gets more than ``fan`` <= ``fan_in``
states of a key, whatever the skew. There are always at least two rounds, as many as the chunks need.

The chunks are counted, not estimated: one job over the input without its columns (of a parquet table it
reads the footers) gives the number of splits and of chunks in the fullest split.

Defined results
    * a null key is a key of its own (its row has a null key); drop it before or after as needed;
    * rows that are repeated count each time; an empty input gives no rows;
    * extra columns are ignored; working columns carry the prefix ``_weft_`` and so cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 1 << 20

#: kind of state -> (how a row enters it, how two states merge)
_STATES = {
    "count": (lambda c: F.count(c), F.sum),
    "sum": (lambda c: F.sum(c), F.sum),
    "min": (lambda c: F.min(c), F.min),
    "max": (lambda c: F.max(c), F.max),
}


def tree_shape(chunks: int, fan_in: int) -> tuple[int, int]:
    """(rounds, fan) of the balanced tree over ``chunks`` leaves: fan ** rounds >= chunks, 2 <= fan <= fan_in."""
    rounds, span = 2, fan_in**2
    while span < chunks:
        rounds, span = rounds + 1, span * fan_in
    fan = max(2, round(max(chunks, 1) ** (1 / rounds)))
    return rounds, min(fan if fan**rounds >= chunks else fan + 1, fan_in)


def _place(chunk_rows: int) -> tuple[Column, Column]:
    """Split number and chunk number inside the split of a row."""
    position = F.monotonically_increasing_id()  # split number in the high bits, row in the low 33
    return F.shiftright(position, 33), F.shiftright(position.bitwiseAND((1 << 33) - 1), int(math.log2(chunk_rows)))


def count_chunks(df: DataFrame, chunk_rows: int) -> tuple[int, int]:
    """Number of input splits with rows before their end, and of chunks in the fullest split."""
    split, chunk = _place(chunk_rows)
    n = df.select(split.alias("s"), chunk.alias("c")).agg(F.max("s").alias("s"), F.max("c").alias("c")).first()
    return (n.s or 0) + 1, (n.c or 0) + 1


def tree_levels(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[tuple[str, str, Column]], *, fan_in: int = 32, chunk_rows: int = CHUNK_ROWS, chunks: tuple[int, int] | None = None
) -> list[DataFrame]:
    """The states after each round: keys, ``_weft_node`` and the aggregates; the last is the root."""
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    if chunk_rows < 1 or chunk_rows & (chunk_rows - 1):
        raise ValueError("chunk_rows must be a power of two")
    splits, per_split = chunks or count_chunks(df, chunk_rows)
    rounds, fan = tree_shape(splits * per_split, fan_in)
    split, chunk = _place(chunk_rows)
    parent = lambda node: F.floor(node / F.lit(fan)).cast("bigint")
    rows = df.select(*[F.col(k) for k in keys], *[c.alias(f"_weft_in_{name}") for name, _, c in aggs], parent(split * per_split + chunk).alias("_weft_node"))
    # leaves: chunk-local combine before the shuffle, the first merge of ``fan`` neighbours after it
    levels = [rows.groupBy(*keys, "_weft_node").agg(*[_STATES[kind][0](F.col(f"_weft_in_{name}")).alias(name) for name, kind, _ in aggs])]
    for level in range(1, rounds):
        # the root is one node even if the input comes in more splits than were counted
        node = F.lit(0).cast("bigint") if level == rounds - 1 else parent(F.col("_weft_node"))
        levels.append(levels[-1].withColumn("_weft_node", node).groupBy(*keys, "_weft_node").agg(*[_STATES[kind][1](name).alias(name) for name, kind, _ in aggs]))
    return levels


def tree_aggregate(df: DataFrame, keys: Sequence[str], aggs: Sequence[tuple[str, str, Column]], **tree) -> DataFrame:
    """Aggregate ``aggs`` (name, kind, column) per ``keys``; kinds: count, sum, min, max.

    ``fan_in``: most states of a key that a merge gets. ``chunk_rows``: rows of a chunk, a power of two.
    ``chunks``: (splits, chunks of the fullest split), where known; else they are counted.
    """
    return tree_levels(df, keys, aggs, **tree)[-1].drop("_weft_node")


def value_profile(df: DataFrame, fields: Sequence[str], *, time_col: str | None = None, **tree) -> DataFrame:
    """Rows, share of all rows and first/last time of every value of each field, by tree aggregation.

    Output: field, key_value (null for missing values), n_rows, table_rows [, first_at, last_at].
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("key_value")) for f in fields])).alias("_weft_kv")
    kept = [] if time_col is None else [F.col(time_col).alias("_weft_time")]
    long = df.select(pairs, *kept).select("_weft_kv.*", *[c for c in ["_weft_time"] if time_col])
    if "chunks" not in tree:  # counted on the table as it is, so that no column is read; a row becomes one for each field
        splits, per_split = count_chunks(df, tree.get("chunk_rows", CHUNK_ROWS))
        tree["chunks"] = (splits, per_split * len(fields))
    aggs = [("n_rows", "count", F.lit(1))]
    if time_col:
        aggs += [("first_at", "min", F.col("_weft_time")), ("last_at", "max", F.col("_weft_time"))]
    values = tree_aggregate(long, ["field", "key_value"], aggs, **tree)
    # one row per field: its size is the number of fields
    total = df.agg(F.count(F.lit(1)).alias("table_rows")).select(F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"), "table_rows")
    return values.join(F.broadcast(total), "field")


def heavy_values(df: DataFrame, fields: Sequence[str], *, one_in: int = 50, **tree) -> DataFrame:
    """The non-null values that more than one in ``one_in`` of all rows hold: field, key_value."""
    v = value_profile(df, fields, **tree)
    return v.where(F.col("key_value").isNotNull() & (F.col("n_rows") * one_in > F.col("table_rows"))).select("field", "key_value")
