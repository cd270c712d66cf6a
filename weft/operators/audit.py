"""Data audit and the deterministic noise sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.functions import text as T
from weft.functions.hashing import crc_slot
from weft.functions.unicode import audit_normalized

# Texts read as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
COLUMNS = ("entity_id", "business_name", "business_address", "country")


def known(column: str):
    c = F.col(column)
    return F.when(c.isNull() | c.isin(*MISSING), None).otherwise(c)


def missing_counts(df: DataFrame) -> DataFrame:
    """column, rows, missing."""
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(known(c).isNull()).alias(c) for c in COLUMNS])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(c).alias("missing")) for c in COLUMNS])).alias("x")).select("x.*")


def country_counts(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(known("country"), F.lit("<MISSING>")).alias("country")).groupBy("country").agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_counts(df: DataFrame) -> DataFrame:
    """what, duplicate_rows (beyond the first), duplicate_values; for ids, normalized names and addresses.

    Ids that are no number count as -1; empty names and addresses don't count.
    """
    norm = df.select(F.coalesce(T.entity_number(F.col("entity_id")), F.lit(-1)).cast("string").alias("id"), audit_normalized(known("business_name")).alias("name"), audit_normalized(known("business_address")).alias("address"))
    long = norm.select(F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).alias("v")) for c in ("id", "name", "address")])).alias("x")).select("x.*")
    counts = long.where(F.col("v").isNotNull() & (F.col("v") != "")).groupBy("what", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("what").agg(F.sum(F.col("n") - 1).alias("duplicate_rows"), F.count_if(F.col("n") > 1).alias("duplicate_values"))


def match_histogram(truth: DataFrame) -> DataFrame:
    """n_matches, n_rows over the rows of the truth table."""
    return truth.select(F.size(T.id_list(F.col("matched_entity_ids"))).alias("n_matches")).groupBy("n_matches").agg(F.count(F.lit(1)).alias("n_rows"))


def origin_classes(truth: DataFrame) -> DataFrame:
    """origin (both, s2_only, s3_only, singleton), n_rows."""
    ids = T.id_list(F.col("matched_entity_ids"))
    two, three = T.starts_with_list(ids, "S2-"), T.starts_with_list(ids, "S3-")
    origin = F.when(two & three, "both").when(two, "s2_only").when(three, "s3_only").otherwise("singleton")
    return truth.select(origin.alias("origin")).groupBy("origin").agg(F.count(F.lit(1)).alias("n_rows"))


def first_per_country(df: DataFrame, n: int = 20_000, order: tuple[str, ...] = ("source", "row_no")) -> DataFrame:
    """The first ``n`` rows of each country with their position; the rank filter prunes before the shuffle."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy("country").orderBy(*order))).where(F.col("position") <= n)


def crc_sample(df: DataFrame, modulus: int, column: str = "entity_id") -> DataFrame:
    return df.where(crc_slot(F.col(column), modulus) == 0)


def noise_pairs(master: DataFrame, targets: DataFrame, truth: DataFrame, modulus: int = 200, pool: int = 20_000) -> DataFrame:
    """label, s1, target and raw fields: all matches of a CRC sample, and one pooled non-match per sampled record."""
    side = lambda df, p, i: df.select(F.col("entity_id").alias(i), *[F.coalesce(c, F.lit("")).alias(f"{p}_{o}") for c, o in (("business_name", "name"), ("business_address", "addr"), ("country", "country"))])
    chosen = crc_sample(truth, modulus, "source1_entity_id").select(F.col("source1_entity_id").alias("s1"), T.id_list(F.col("matched_entity_ids")).alias("ids")).distinct()
    left = side(master, "a", "s1")
    positive = chosen.select("s1", F.explode("ids").alias("target")).distinct().join(side(targets, "b", "target"), "target").join(left, "s1").withColumn("label", F.lit("positive"))
    pooled = first_per_country(targets, pool)
    sizes = pooled.groupBy("country").agg(F.count(F.lit(1)).alias("size"))  # a row per country
    slots = chosen.join(left, "s1").join(sizes, F.col("a_country") == F.col("country")).withColumn("slot", crc_slot(F.col("s1"), F.col("size")) + 1)
    right = pooled.select(F.col("entity_id").alias("target"), "country", F.col("position").cast("bigint").alias("slot"), *[F.coalesce(c, F.lit("")).alias(o) for c, o in (("business_name", "b_name"), ("business_address", "b_addr"), ("country", "b_country"))])
    negative = slots.drop("size").join(right, ["country", "slot"]).where(~F.array_contains("ids", F.col("target"))).withColumn("label", F.lit("negative"))
    cols = ["label", "s1", "target", "a_name", "a_addr", "a_country", "b_name", "b_addr", "b_country"]
    return positive.select(*cols).unionByName(negative.select(*cols))


def means_by_label(indicators: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return indicators.groupBy("label").agg(F.count(F.lit(1)).alias("pairs"), *[F.round(F.avg(c), 4).alias(c) for c in columns])
