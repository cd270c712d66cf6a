"""Delimited sources and sinks of the linkage pipeline, and parquet tables."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a tab-separated file with a header: four fields by position, no quoting.

    The fourth field keeps further tabs; missing fields are empty; a carriage return at the end is dropped.
    """
    lines = spark.read.text(path).withColumn("_weft_line", F.regexp_replace("value", "\r$", ""))
    header = F.col("_weft_line").startswith("entity_id\t")
    parts = F.split(F.col("_weft_line"), "\t", 4)
    return lines.where(~header & (F.col("_weft_line") != "")).select(*[F.coalesce(F.get(parts, F.lit(i)), F.lit("")).alias(f.name) for i, f in enumerate(ENTITY)])


def read_quoted(spark: SparkSession, path: str, schema: T.StructType | None = None, *, multi_line: bool = False) -> DataFrame:
    """A tab-separated file with a header in which double quotes quote. With ``multi_line`` quoted fields may hold line feeds; such a file can't be split."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, quote='"', escape='"', multiLine=multi_line)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=TRUTH, quote="")


def read_split(spark: SparkSession, root: str, split: str) -> dict[str, DataFrame]:
    """The three source files of a split and, where there is one, its truth."""
    out = {f"source{k}": read_entities(spark, f"{root}/{split}_source{k}.tsv") for k in (1, 2, 3)}
    truth = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{split}_ground_truth.tsv")  # any file system Spark reads
    if truth.getFileSystem(spark._jsc.hadoopConfiguration()).exists(truth):
        out["truth"] = read_truth(spark, f"{root}/{split}_ground_truth.tsv")
    return out


def in_file_order(df: DataFrame, column: str = "_weft_at") -> DataFrame:
    """A parquet scan with the place of each row, (file, row), as a column that sorts."""
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(column))


def write_document(spark: SparkSession, text: str, path: str) -> None:
    """One text (a model, a metrics document) as a folder with one file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> str:
    """What ``write_document`` wrote; '' for an empty folder."""
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect()).removesuffix("\n")


def columns_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a tab-separated file; reads its first line only."""
    return spark.read.csv(path, sep="\t", header=True).columns


def line_count(*lists: DataFrame) -> int:
    """Rows of all lists as they arrived, repeated ones included."""
    return sum(df.count() for df in lists)


def write_tsv(df: DataFrame, path: str, *, significant: int | None = None, decimals: int | None = None, whole: tuple[str, ...] = ()) -> None:
    """Tab-separated with a header. ``significant``: digits of doubles, ``decimals``: places of doubles; columns in ``whole`` are written as integers."""
    form = f"%.{significant}g" if significant else f"%.{decimals}f" if decimals is not None else None
    df = df.withColumns({c: F.col(c).cast("bigint") for c in whole})
    out = [F.format_string(form, F.col(f.name)).alias(f.name) if form and isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema]
    df.select(*out).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", escapeQuotes=False, emptyValue="")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_json(rows: DataFrame, path: str) -> None:
    """A few rows as one indented JSON document (metrics, audits)."""
    Path(path).write_text(json.dumps([r.asDict(recursive=True) for r in rows.collect()], indent=2, ensure_ascii=False, default=str))


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
