"""The N best items of every group.

Method: ``row_number`` ordered by score and identifier with a filter on the rank. Catalyst turns the
filter into a WindowGroupLimit before and after the shuffle, so a task sends on at most N rows of a
group however large the group is, and no task ever holds a whole group.

Defined results
    * null and NaN scores don't count; rows with a null group or item don't count;
    * an item that occurs more than once in a group counts once, with its highest score;
    * ties: higher ``source digit`` of the id, then the larger number of the id, then the larger text,
      so the order is total; ids without a number come after all with one;
    * groups with fewer items give all they have; an empty table gives no rows;
    * extra columns are ignored; working columns carry the prefix ``_weft_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def id_order(item: Column) -> list[Column]:
    """Descending order of ids ``S<k>-<number>``: list k, then number, then text."""
    digit = F.try_element_at(F.split(item, "-", 2), F.lit(1))
    number = F.try_element_at(F.split(item, "-", 2), F.lit(2))
    return [digit.substr(2, 20).try_cast("bigint"), number.try_cast("decimal(38,0)"), item]


def top_n_per_group(df: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    """group, item, score, rank of the ``n`` best distinct items of every group."""
    scored = df.select(F.col(group).alias("_weft_g"), F.col(item).alias("_weft_i"), F.col(score).cast("double").alias("_weft_s"))
    scored = scored.where(F.col("_weft_g").isNotNull() & F.col("_weft_i").isNotNull() & F.col("_weft_s").isNotNull() & ~F.isnan("_weft_s"))
    best = scored.groupBy("_weft_g", "_weft_i").agg(F.max("_weft_s").alias("_weft_s"))
    order = [F.col("_weft_s").desc(), *[c.desc_nulls_last() for c in id_order(F.col("_weft_i"))]]
    ranked = best.withColumn("_weft_rank", F.row_number().over(Window.partitionBy("_weft_g").orderBy(*order))).where(F.col("_weft_rank") <= n)
    return ranked.select(F.col("_weft_g").alias(group), F.col("_weft_i").alias(item), F.col("_weft_s").alias(score), F.col("_weft_rank").alias("rank"))
