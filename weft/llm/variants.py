"""Spellings of one name under different identifiers.

Method: metric-space partitioning. Names are reduced to keys, their own words without legal form, line
of business and given name: as sounded, in order and sorted, for radius ``RADIUS``, and their consonants
for radius ``BONE_RADIUS``. All keys of a kind within the Levenshtein radius R of each other are found
exactly:

1. every key is assigned to the nearest of ``pivots`` pivot keys, its home cell;
2. for a pair within R whose homes are i and j, d(x, p_j) <= d(x, p_i) + 2R by the triangle inequality,
   so replicating x to the cells below its home that satisfy it makes each pair meet in a cell, once;
3. inside a cell the radius join is exact and distributed: a key is cut into R + 1 segments, one of which
   survives R edits, so partners meet on (cell, length, segment) and are verified with the metric.

Cells are join keys, never tasks: a cell may hold any number of keys. Names, not records, are compared;
records come back by an equi-join on their name. Key pairs are then verified on the whole names (same
numbers and line of business, given names compatible, own words alike). Two names that both belong to a
third are a pair as well, if they don't contradict each other and differ by no more than ``BRIDGED`` edits:
two mistyped forms of one name can be farther apart than either is from the name itself.

Defined results
    * null and empty names take part in no pair, neither do names without letters and digits;
    * names that are equal when case, accents, blanks, punctuation and unseen differences are
      disregarded are no variants of each other;
    * repeated rows give one pair; an id paired with itself is left out; ids are put in order as text;
    * an empty table gives no rows; very long names are compared whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.names import bone_keys, heard_keys, packed_name, plain, same_name, unpacked_name
from weft.session import cut, discard, ship

RADIUS, BONE_RADIUS, PIVOTS = 2, 1, 4
BRIDGED = 6
#: keys looked at when pivots are chosen; pivots change the cost, never the result
PIVOT_SAMPLE = 1000


def name_forms(names: DataFrame, column: str) -> DataFrame:
    """raw, norm, fold, what (the parts as one text), keys, bones of every distinct non-null name."""
    ship(names.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            norm = [" ".join(plain(v).split()) for v in b.column(0).to_pylist()]
            what = [packed_name(n) for n in norm]
            parsed = [unpacked_name(w) for w in what]
            cols = [b.column(0), pa.array(norm, pa.string()), pa.array([f for f, _ in parsed], pa.string()), pa.array(what, pa.string()), *[pa.array([f(p) for _, p in parsed], pa.list_(pa.string())) for f in (heard_keys, bone_keys)]]
            yield pa.RecordBatch.from_arrays(cols, ["raw", "norm", "fold", "what", "keys", "bones"])

    distinct = names.select(F.col(column).cast("string").alias("raw")).where(F.col("raw").isNotNull()).distinct()
    return distinct.mapInArrow(run, "raw string, norm string, fold string, what string, keys array<string>, bones array<string>").where(F.col("fold") != "")


def choose_pivots(keys: DataFrame, n: int) -> list[str]:
    """Keys far from each other, of a bounded sample."""
    from weft.llm.names import edits

    sample = [r[0] for r in keys.orderBy(F.xxhash64("key"), "key").limit(PIVOT_SAMPLE).collect()]
    if not sample:
        return []
    sample.sort(key=lambda k: (len(k), k))
    pivots = [sample[len(sample) // 2]]
    far = [edits(pivots[0], k, 40) for k in sample]
    while len(pivots) < min(n, len(sample)):
        at = max(range(len(sample)), key=lambda i: (far[i], -i))
        if not far[at]:
            break
        pivots.append(sample[at])
        far = [min(f, edits(sample[at], k, 40)) for f, k in zip(far, sample)]
    return pivots


def members(keys: DataFrame, radius: int, pivots: int) -> DataFrame:
    """key, cell, mine (whether the cell is the key's home): the home cell of every key and the lower ones it is near to."""
    chosen = choose_pivots(keys, pivots)
    points = F.array(*[F.lit(p) for p in chosen]) if chosen else F.array().cast("array<string>")
    # distinct keys are few rows that become many, so they are spread before
    spread = keys.repartition(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    away = spread.select("key", F.transform(points, lambda p: F.levenshtein(F.col("key"), p)).alias("d")).where(F.size("d") > 0)
    home = away.select("key", "d", (F.array_position("d", F.array_min("d")) - 1).cast("int").alias("home"))
    near = F.filter(F.sequence(F.lit(0), F.col("home")), lambda j: F.get("d", j) <= F.array_min("d") + 2 * radius)
    return home.select("key", "home", F.explode(near).alias("cell")).select("key", "cell", (F.col("cell") == F.col("home")).alias("mine"))


def radius_pairs(keys: DataFrame, radius: int = RADIUS, pivots: int = PIVOTS) -> DataFrame:
    """a, b (a < b) of all distinct keys within the radius."""
    parts = radius + 1
    inside = members(keys, radius, pivots).withColumn("n", F.length("key"))
    # segment s (from 0) of a key of length n: from s*n/parts, as even as can be
    start = lambda n, s: F.floor(n * s / F.lit(parts)).cast("int")
    meet = lambda piece: F.xxhash64("cell", "l", "s", piece).alias("at")
    one, other = F.col("n"), F.col("l")
    index = inside.select("key", "mine", "cell", F.col("n").alias("l"), F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("s"))
    piece = F.expr("substring(key, cast(floor(l * s / {0}) as int) + 1, cast(floor(l * (s + 1) / {0}) as int) - cast(floor(l * s / {0}) as int))".format(parts))
    index = index.select(meet(piece), F.col("key").alias("short"), F.col("mine").alias("short_mine"))
    probe = inside.select("key", "mine", "cell", "n", F.explode(F.sequence(F.greatest(one - radius, F.lit(0)), one)).alias("l"), F.expr(f"sequence(0, {radius})").alias("ss"))
    probe = probe.select("key", "mine", "cell", "n", "l", F.explode("ss").alias("s"))
    begin, gap = start(other, F.col("s")), one - other
    lo = F.greatest(F.lit(0), begin - F.col("s"), begin + gap - (radius - F.col("s")))
    hi = F.least(begin + F.col("s"), begin + gap + (radius - F.col("s")))
    probe = probe.select("key", "mine", "cell", "n", "l", "s", start(other, F.col("s") + 1).alias("e"), begin.alias("b"), lo.alias("lo"), hi.alias("hi")).where(F.col("lo") <= F.col("hi"))
    probe = probe.select("key", "mine", "cell", "l", "s", F.explode(F.sequence("lo", "hi")).alias("p"), (F.col("e") - F.col("b")).alias("w"), "n").where(F.col("p") + F.col("w") <= F.col("n"))
    probe = probe.select(meet(F.expr("substring(key, p + 1, w)")), F.col("key").alias("long"), F.col("mine").alias("long_mine"))
    met = probe.join(index, "at").where((F.col("long") != F.col("short")) & (F.col("long_mine") | F.col("short_mine")))
    close = met.where(F.levenshtein("long", "short", radius) >= 0)
    return close.select(F.least("long", "short").alias("a"), F.greatest("long", "short").alias("b")).distinct()


def _candidates(names: DataFrame, kind: str, radius: int, pivots: int) -> DataFrame:
    """x, y: numbers of the names with keys of one kind within the radius, written."""
    by_key = names.select("name", F.xxhash64("fold").alias("f"), F.explode(kind).alias("key")).distinct()
    keys = cut(by_key.select("key").distinct())
    met = radius_pairs(keys, radius, pivots).unionByName(keys.select(F.col("key").alias("a"), F.col("key").alias("b")))
    side = lambda k, n, f: by_key.select(F.col("key").alias(k), F.col("name").alias(n), F.col("f").alias(f))
    cand = met.join(side("a", "x", "fx"), "a").join(side("b", "y", "fy"), "b").where(F.col("fx") != F.col("fy"))
    out = cut(cand.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
    discard(keys)
    return out


def _verified(pairs: DataFrame, names: DataFrame, radius: int, share: int) -> DataFrame:
    part = lambda n, w: names.select(F.col("name").alias(n), F.col("what").alias(w))
    full = pairs.join(part("x", "wx"), "x").join(part("y", "wy"), "y").select("x", "y", "wx", "wy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                (fold_x, p), (fold_y, q) = unpacked_name(x), unpacked_name(y)
                keep.append(fold_x != fold_y and same_name(p, q, radius, share))
            yield b.filter(pa.array(keep, pa.bool_())).select(["x", "y"])

    return full.mapInArrow(run, "x long, y long")


def two_steps(pairs: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """x, y (x < y) that are no pair themselves but both paired with a third."""
    one, other = F.col(x), F.col(y)
    both = pairs.select(one.alias("m"), other.alias("n")).unionByName(pairs.select(other.alias("m"), one.alias("n")))
    met = both.select("m", F.col("n").alias(x)).join(both.select("m", F.col("n").alias(y)), "m").where(F.col(x) < F.col(y))
    return met.select(x, y).distinct().join(pairs.select(F.least(x, y).alias(x), F.greatest(x, y).alias(y)), [x, y], "left_anti")


def linked_classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """id, class_id, n_links from members (id, form, number) of classes and links (x, y) between their numbers.

    Only counts move along the links, so a class of many records costs as much as one of two.
    """
    classes = members.groupBy("form").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("_size"), F.first("number").alias("number"))
    both = links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    beside = both.join(classes.where(F.col("number").isNotNull()).select(F.col("number").alias("y"), "_size"), "y").groupBy(F.col("x").alias("number")).agg(F.sum("_size").alias("_beside"))
    sized = classes.join(beside, "number", "left").select("form", "class_id", (F.col("_size") - 1 + F.coalesce("_beside", F.lit(0))).alias("n_links"))
    return members.join(sized, "form").select("id", "class_id", "n_links")


def variant_links(df: DataFrame, key: str, name: str, *, radius: int = RADIUS, bone_radius: int = BONE_RADIUS, pivots: int = PIVOTS, bridged: int = BRIDGED) -> tuple[DataFrame, DataFrame]:
    """Classes of records with one spelling and the links between spellings: (id, norm, name) and (x, y), numbers of names."""
    named = df.select(F.col(key).cast("string").alias("id"), F.col(name).cast("string").alias("raw")).where(F.col("id").isNotNull() & F.col("raw").isNotNull())
    forms = cut(name_forms(named, "raw"))
    names = cut(forms.select("norm", "fold", "what", "keys", "bones").dropDuplicates(["norm"]).withColumn("name", F.monotonically_increasing_id()))
    cand = _candidates(names, "keys", radius, pivots).unionByName(_candidates(names, "bones", bone_radius, pivots)).distinct()
    same = cut(_verified(cand, names, 3, 5))
    if bridged:
        same = same.unionByName(_verified(two_steps(same), names, bridged, 2))
    return named.join(forms.select("raw", "norm"), "raw").select("id", "norm").distinct().join(names.select("norm", "name"), "norm"), same


def variant_pairs(df: DataFrame, key: str, name: str, **options) -> DataFrame:
    """id_a, id_b, name_a, name_b: every pair of records whose names are spellings of one another, from ``variant_links``."""
    ids, same = variant_links(df, key, name, **options)
    side = lambda n, i, t: ids.select(F.col("name").alias(n), F.col("id").alias(i), F.col("norm").alias(t))
    both = same.join(side("x", "p", "px"), "x").join(side("y", "q", "qy"), "y").where(F.col("p") != F.col("q"))
    first = F.col("p") < F.col("q")
    return both.select(F.when(first, F.col("p")).otherwise(F.col("q")).alias("id_a"), F.when(first, F.col("q")).otherwise(F.col("p")).alias("id_b"), F.when(first, F.col("px")).otherwise(F.col("qy")).alias("name_a"), F.when(first, F.col("qy")).otherwise(F.col("px")).alias("name_b"))


def variant_classes(df: DataFrame, key: str, name: str, **options) -> DataFrame:
    """id, class_id, n_links: a row for each record and spelling of it. ``class_id`` is the smallest id with that spelling, ``n_links`` the other records with it or a variant."""
    ids, same = variant_links(df, key, name, **options)
    return linked_classes(cut(ids).select("id", F.col("norm").alias("form"), F.col("name").alias("number")), same)
