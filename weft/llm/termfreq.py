"""How often every term occurs, in how many records, and which terms are too rare or too common.

Method: last-seen counters. Values are hash-partitioned by record and their tokens ordered by record
inside a partition. A term's counter holds three numbers, occurrences, records and the record it was last
seen in: a token counts as a further record where its record is another than the last seen one, so no set
of records is kept for a term, and a record that arrives in several rows, or gives a term in several
values, counts once. All of a record lies in one partition; the counters of the partitions therefore add
up, and a second, map-side combined aggregation by term does that.

A term that stands in every record is spread over all partitions like the records themselves and leaves
one counter in each, so heavy terms need no salt. What crosses the network is each value once (not each
token), and then the counters. Rows without a record identifier are spread over all partitions. Rows of
one identifier share a partition; an identifier is a record, so its rows are few.

Defined results
    * a null value is no record; an empty value, or one of blanks only, is a record without terms;
    * rows of one record identifier are one record, whatever their number; every row counts for the
      occurrences; a row with a null identifier is a record of its own, and ``last_record`` is null if a
      term has no other;
    * an empty table gives no rows;
    * a term that only one record holds is ``rare`` and, where the field has fewer than ``one_in``
      records, ``common`` as well (both marks are true statements then);
    * extra columns are ignored, whatever their names; very long values are processed whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: slices of the records for each shuffle partition, so that the partitions fill evenly
SLICES = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def blank_terms(value: Column) -> Column:
    """The non-empty pieces between U+0020, with A-Z made lower case and nothing else changed."""
    return F.filter(F.split(F.translate(value, _UPPER, _LOWER), " ", -1), lambda t: t != "")


def term_counters(df: DataFrame, fields: Sequence[str], record: str, tokenizer=blank_terms) -> DataFrame:
    """field, term, occurrences, records, last_record for every term of every field."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a row without an identifier is told apart by its position
    alone = F.when(F.col(record).isNull(), F.monotonically_increasing_id())
    part = F.pmod(F.when(alone.isNull(), F.xxhash64(record)).otherwise(F.xxhash64(alone)), F.lit(parts * SLICES)).cast("int")
    rows = df.select(F.col(record).alias("_weft_record"), alone.alias("_weft_alone"), part.alias("_weft_part"), *[F.col(f).cast("string").alias(f"_weft_v{i}") for i, f in enumerate(fields)])
    rows = rows.where(F.coalesce(*[F.col(f"_weft_v{i}") for i in range(len(fields))]).isNotNull()).repartition(parts, "_weft_part")
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_weft_v{i}").alias("value")) for i, f in enumerate(fields)]))
    tokens = rows.select("_weft_part", "_weft_record", "_weft_alone", values.alias("_weft_v"))
    tokens = tokens.select("_weft_part", "_weft_record", "_weft_alone", F.col("_weft_v.field").alias("field"), F.explode(tokenizer(F.col("_weft_v.value"))).alias("term"))
    # the stream of a term inside a partition, in order of the records; partitioned by _weft_part already, so only sorted
    stream = Window.partitionBy("_weft_part", "field", "term").orderBy("_weft_record", "_weft_alone")
    here = F.struct(F.col("_weft_record").alias("r"), F.col("_weft_alone").alias("a"))
    seen = tokens.select("_weft_part", "field", "term", "_weft_record", (~F.lag(here).over(stream).eqNullSafe(here)).alias("_weft_fresh"))
    counters = seen.groupBy("_weft_part", "field", "term").agg(F.count(F.lit(1)).alias("occurrences"), F.count_if("_weft_fresh").alias("records"), F.max("_weft_record").alias("last_record"))
    return counters.groupBy("field", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"), F.max("last_record").alias("last_record"))


def field_sizes(df: DataFrame, fields: Sequence[str], record: str) -> DataFrame:
    """field, field_records: the records with a non-null value. One row per field."""
    flags = df.select(F.col(record).alias("_weft_record"), *[F.col(f).isNotNull().cast("int").alias(f"n{i}") for i, f in enumerate(fields)])
    known = flags.where(F.col("_weft_record").isNotNull()).groupBy("_weft_record").agg(*[F.max(f"n{i}").alias(f"n{i}") for i in range(len(fields))]).drop("_weft_record")
    sizes = known.unionByName(flags.where(F.col("_weft_record").isNull()).drop("_weft_record")).agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(fields))])
    return sizes.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"n{i}").alias("field_records")) for i, f in enumerate(fields)])).alias("s")).select("s.*")


def marked_terms(df: DataFrame, fields: Sequence[str], record: str, *, rare_at_most: int = 1, one_in: int = 50) -> DataFrame:
    """All terms with their counters and the array ``marks`` (subset of rare, common)."""
    sizes = F.broadcast(field_sizes(df, fields, record))  # as many rows as there are fields
    rare = F.when(F.col("records") <= rare_at_most, F.lit("rare"))
    common = F.when(F.col("records") * one_in > F.col("field_records"), F.lit("common"))
    return term_counters(df, fields, record).join(sizes, "field").withColumn("marks", F.array_compact(F.array(rare, common)))


def rare_or_common(df: DataFrame, fields: Sequence[str], record: str, **bounds: int) -> DataFrame:
    """field, term, mark: one row for each mark of a term."""
    return marked_terms(df, fields, record, **bounds).select("field", "term", F.explode("marks").alias("mark"))
