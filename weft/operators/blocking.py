"""Candidate generation: rare-token blocking keys, skew caps, evidence and top-k.

A record yields keys (tag, country, value). Tags 1 and 2 are the whole normalized name and address, 3 and
4 rare words, 5 and 6 rare trigrams, 7 and 8 pairs of rare trigrams. Rarity is the number of master
records that hold a value, over all countries. Every step is an equi-join or an aggregation with map-side
combine; the bucket cap is part of the reference semantics and is applied to the keys before the join,
so no key ever multiplies more than ``max_bucket`` master records.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions import similarity as S
from weft.functions import text as T
from weft.session import cut, discard, packed, picked

KINDS = {"name_toks": 1, "addr_toks": 2, "name_grams": 3, "addr_grams": 4}
COMPOUND = 8
#: records for which a whole run has one pass more, and the most passes: what a pass shuffles is gone before the next; the result is the same
PASS_RECORDS, MOST_PASSES = 50_000, 16
EVIDENCE = ("name_tok", "addr_tok", "name_gram", "addr_gram", "name_pair", "addr_pair")


@dataclass(frozen=True)
class BlockingConfig:
    """Parameters of a run. The defaults, and those of the two runs of the pipeline."""

    sample_mod: int = 10
    sample_rem: int = 0
    max_df: int = 80
    max_bucket: int = 300
    top_k: int = 100
    min_dice: float = 0.40

    @property
    def gram_df(self) -> int:
        return max(1, self.max_df // 100)

    @classmethod
    def parse(cls, **options: str) -> "BlockingConfig":
        """From options as text; what is not given has its default."""
        known = {"sample_mod", "sample_rem", "max_df", "max_bucket", "top_k"}
        if unknown := set(options) - known:
            raise ValueError(f"unknown options: {sorted(unknown)}")
        return cls(**{k: int(v) for k, v in options.items()})

    @classmethod
    def training(cls) -> "BlockingConfig":
        """One master record in a hundred, to mine training pairs from."""
        return cls(sample_mod=100, max_df=1000, max_bucket=5, top_k=100)

    @classmethod
    def whole(cls) -> "BlockingConfig":
        """All master records under the frequency limit of the training run, for lists as small as a sample of it."""
        return cls(sample_mod=1, max_df=1000, max_bucket=20, top_k=50)

    @classmethod
    def full(cls) -> "BlockingConfig":
        """All master records of an inference run."""
        return cls(sample_mod=1, max_df=80_000, max_bucket=20, top_k=50)


def long_values(rec: DataFrame) -> DataFrame:
    """source, num, country, kind, val of all words and trigrams of the records."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("vals")) for c, k in KINDS.items()])
    return rec.select("source", "num", "country", F.explode(kinds).alias("x")).select("source", "num", "country", "x.kind", F.explode("x.vals").alias("val"))


def document_frequency(values: DataFrame) -> DataFrame:
    """kind, val, df over the records of ``values`` (sets, so a record counts once)."""
    return values.groupBy("kind", "val").agg(F.count(F.lit(1)).alias("df"))


def rare_values(values: DataFrame, df: DataFrame, config: BlockingConfig) -> DataFrame:
    """The known values of each record with their rank by rarity (ties by value), rank at most 9."""
    known = values.join(df.where(F.col("df") <= config.max_df), ["kind", "val"])
    order = Window.partitionBy("source", "num", "kind").orderBy("df", "val")
    return known.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 9)


def compound_values(rare: DataFrame) -> DataFrame:
    """Unordered pairs of the eight rarest trigrams of each record and field."""
    eight = rare.where((F.col("kind") >= 3) & (F.col("rank") <= COMPOUND)).groupBy("source", "num", "country", "kind").agg(F.sort_array(F.collect_list("val")).alias("v"))
    return eight.select("source", "num", "country", (F.col("kind") + 4).alias("tag"), F.explode(T.unordered_pairs(F.col("v"))).alias("val"))


def _turn(value: Column, n: int) -> Column:
    """The pass of n of this value."""
    return F.pmod(F.xxhash64(value), F.lit(n))


def rare_lists(rare: DataFrame) -> DataFrame:
    """One row a record and kind with its rare values as v, so that they are ranked once for single ones and pairs."""
    return rare.groupBy("source", "num", "country", "kind").agg(F.collect_list(F.struct("rank", "df", "val")).alias("v"))


def blocking_keys(rec: DataFrame, rare: DataFrame, config: BlockingConfig) -> DataFrame:
    """tag, country, val, source, num of all blocking keys."""
    return keys_of_lists(rec, rare_lists(rare), config)


def keys_of_lists(rec: DataFrame, own: DataFrame, config: BlockingConfig, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """tag, country, val, source, num of the blocking keys of the k-th of n passes: those whose value, or smaller value of a pair, is of it."""
    k, n = turn
    mine = lambda v: _turn(v, n) == k if n > 1 else F.lit(True)
    words = F.when(F.col("source") == 1, 3).otherwise(5)
    grams = F.when(F.col("source") == 1, 5).otherwise(9)
    wanted = lambda x: F.when(F.col("kind") <= 2, x["rank"] <= words).otherwise((x["rank"] <= grams) & (x["df"] <= config.gram_df)) & mine(x["val"])
    tagged = lambda vals, more: F.transform(vals, lambda v: F.struct((F.col("kind") + more).alias("tag"), v.alias("val")))
    vals = lambda keep: F.transform(F.filter("v", keep), lambda x: x["val"])
    pairs = F.when(F.col("kind") >= 3, T.unordered_pairs(F.sort_array(vals(lambda x: x["rank"] <= COMPOUND)), mine if n > 1 else None)).otherwise(F.array().cast("array<string>"))
    keys = own.select("source", "num", "country", F.explode(F.concat(tagged(vals(wanted), 2), tagged(pairs, 4))).alias("x")).select("x.tag", "country", "x.val", "source", "num")
    whole = rec.select("country", "source", "num", F.explode(F.array(F.struct(F.lit(1).alias("tag"), F.col("name_norm").alias("val")), F.struct(F.lit(2).alias("tag"), F.col("addr_norm").alias("val")))).alias("x"))
    whole = whole.select("x.tag", "country", "x.val", "source", "num").where((F.col("val") != "") & mine(F.col("val")))
    return whole.unionByName(keys)


KEY = ("tag", "country", "val")


def capped_keys(keys: DataFrame, config: BlockingConfig) -> DataFrame:
    """tag, country, val, s1: the master records' keys that at most ``max_bucket`` of them share.

    The bucket is counted over the key's partition, which the join that follows finds as it needs it.
    """
    master = keys.where(F.col("source") == 1).select(*KEY, F.col("num").alias("s1"))
    return master.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*KEY))).where(F.col("n") <= config.max_bucket).drop("n")


def block_hits(master_keys: DataFrame, keys: DataFrame) -> DataFrame:
    """tag, s1, source, num: a row for each key that a target shares with a master record."""
    return master_keys.join(keys.where(F.col("source") > 1), [*KEY]).select("tag", "s1", "source", "num")


def evidence(hits: DataFrame) -> DataFrame:
    """Per pair: whether name and address are equal, and six hit counts, at most 15 each."""
    counts = [F.least(F.lit(15), F.count_if(F.col("tag") == t)).cast("int").alias(n) for t, n in enumerate(EVIDENCE, 3)]
    return hits.groupBy("s1", "source", "num").agg(F.max((F.col("tag") == 1).cast("int")).alias("name_hit"), F.max((F.col("tag") == 2).cast("int")).alias("addr_hit"), *counts)


def retrieval_hits(e: DataFrame) -> DataFrame:
    exact = F.greatest("name_hit", "addr_hit")
    return e.withColumn("hits", F.col("name_tok") + F.col("addr_tok") + F.col("name_gram") + F.col("addr_gram") + 3 * (F.col("name_pair") + F.col("addr_pair")) + 5 * exact)


def kept(e: DataFrame) -> DataFrame:
    """Pairs with enough evidence to be compared."""
    c = F.col
    enough = (c("name_hit") + c("addr_hit") > 0) | (c("name_pair") >= 1) | (c("addr_pair") >= 1) | ((c("name_tok") >= 1) & (c("name_gram") >= 1)) | ((c("addr_tok") >= 1) & (c("addr_gram") >= 1)) | (c("name_gram") >= 3) | (c("addr_gram") >= 4)
    return e.where(enough)


def ranked(pairs: DataFrame, rec: DataFrame, config: BlockingConfig) -> DataFrame:
    """Kept pairs with both dice values and their rank score, gated by the larger dice."""
    # the arrays go along with every pair: trigrams as numbers, and the pairs that carry them are not sorted
    codes = lambda c: F.transform(c, lambda g: F.conv(g, 16, 10).cast("int"))
    cols = {"name_grams": codes("name_grams"), "addr_grams": codes("addr_grams"), "addr_nums": F.col("addr_nums")}
    a = rec.where(F.col("source") == 1).select(F.col("num").alias("s1"), *[c.alias(f"a_{x}") for x, c in cols.items()])
    b = rec.where(F.col("source") > 1).select("source", "num", *[c.alias(f"b_{x}") for x, c in cols.items()])
    narrow = retrieval_hits(pairs).select("s1", "source", "num", "hits", (F.col("name_hit") + F.col("addr_hit") == 2).cast("int").alias("exact"))
    both = narrow.join(a, "s1").join(b.hint("shuffle_hash"), ["source", "num"])
    both = both.withColumn("name_dice", S.dice(F.col("a_name_grams"), F.col("b_name_grams"))).withColumn("addr_dice", S.dice(F.col("a_addr_grams"), F.col("b_addr_grams")))
    both = both.where(F.greatest("name_dice", "addr_dice") >= config.min_dice)
    common = F.arrays_overlap("a_addr_nums", "b_addr_nums")
    conflict = (F.size("a_addr_nums") > 0) & (F.size("b_addr_nums") > 0) & ~common
    score = F.greatest("name_dice", "addr_dice") + 0.70 * F.least("name_dice", "addr_dice") + 0.08 * common.cast("int") - 0.12 * conflict.cast("int") + 0.05 * F.col("exact") + 0.002 * F.least("hits", F.lit(10))
    return both.select("s1", "source", "num", "hits", "name_dice", "addr_dice", score.cast("float").alias("rank_score"))


def top_candidates(scored: DataFrame, config: BlockingConfig) -> DataFrame:
    """The best ``top_k`` targets of each master record over both lists; ties by list, then number, descending."""
    order = Window.partitionBy("s1").orderBy(F.col("rank_score").desc(), F.col("source").desc(), F.col("num").desc())
    return scored.withColumn("position", F.row_number().over(order)).where(F.col("position") <= config.top_k)


def stages(rec: DataFrame, config: BlockingConfig, materialize: bool = False) -> dict[str, DataFrame]:
    """Every stage of candidate generation by name, as lazy plans over one table of records.

    The join of blocking keys uses the rare values three times; ``materialize`` writes them once (at most
    36 rows a record), so that the ranking per record isn't repeated.
    """
    values = long_values(rec)
    df = document_frequency(values.where(F.col("source") == 1))
    rare = rare_values(values, df, config)
    rare = cut(rare) if materialize else rare
    keys = blocking_keys(rec, rare, config)
    hits = block_hits(capped_keys(keys, config), keys)
    ev = evidence(hits)
    scored = ranked(kept(ev), rec, config)
    return {"values": values, "df": df, "rare": rare, "compound": compound_values(rare), "keys": keys, "hits": hits, "evidence": ev, "kept": kept(ev), "ranked": scored, "top": top_candidates(scored, config)}


def top_by_passes(rec: DataFrame, config: BlockingConfig) -> DataFrame:
    """``stages(...)["top"]`` of records that are written (``packed``), as many passes as they need.

    Values are ranked by record, keys meet by value and pairs are ranked by master record, each in passes that are written
    before the next. Counts of the passes add up, since a key is of one pass; a bucket and a top-k list are whole in theirs.
    """
    n = max(1, min(MOST_PASSES, picked(rec, "num").count() // PASS_RECORDS))
    if n == 1:
        return stages(rec, config)["top"]
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    sets = lambda: picked(rec, "source", "num", "country", *KINDS)
    df = packed(document_frequency(long_values(sets().where("source = 1"))).where(F.col("df") <= config.max_df))
    own = [packed(rare_lists(rare_values(long_values(sets().where(_turn(F.col("num"), n) == k)), df, config))) for k in range(n)]
    parts = []
    for k in range(n):
        keys = keys_of_lists(picked(rec, "source", "num", "country", "name_norm", "addr_norm"), union(own), config, (k, n))
        parts.append(packed(evidence(block_hits(capped_keys(keys, config), keys))))
    for used in (df, *own):
        discard(used)
    flags = [F.max(c).alias(c) for c in ("name_hit", "addr_hit")]
    counts = [F.least(F.lit(15), F.sum(c)).cast("int").alias(c) for c in EVIDENCE]
    top = []
    for k in range(n):
        ev = union(parts).where(_turn(F.col("s1"), n) == k).groupBy("s1", "source", "num").agg(*flags, *counts)
        r = picked(rec, "source", "num", "name_grams", "addr_grams", "addr_nums").where((F.col("source") > 1) | (_turn(F.col("num"), n) == k))
        top.append(packed(top_candidates(ranked(kept(ev), r, config), config)))
    for used in parts:
        discard(used)
    return union(top)


def master_index(master: DataFrame, config: BlockingConfig) -> tuple[DataFrame, DataFrame]:
    """Document frequencies and capped keys of the master records, written once for any number of target batches."""
    values = long_values(master)
    df = cut(document_frequency(values).where(F.col("df") <= config.max_df))
    return df, cut(capped_keys(blocking_keys(master, rare_values(values, df, config), config), config))


def scored_targets(master: DataFrame, index: tuple[DataFrame, DataFrame], targets: DataFrame, config: BlockingConfig) -> DataFrame:
    """Ranked pairs of a batch of prepared targets with the indexed master records. The work follows the batch and what it meets."""
    df, master_keys = index
    keys = blocking_keys(targets, rare_values(long_values(targets), df, config), config)
    pairs = kept(evidence(block_hits(master_keys, keys)))
    met = master.join(pairs.select(F.col("s1").alias("num")).distinct(), "num", "left_semi")
    return ranked(pairs, met.unionByName(targets), config)
