"""Ingested records: one row per entity with everything that is computed once per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions import text as T

FIELDS = ("entity_id", "business_name", "business_address", "country")


def latest(df: DataFrame, order: str = "row_no") -> DataFrame:
    """One row per entity_id, the one that arrived last. Aggregates map-side; nothing is sorted."""
    value = F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in FIELDS[1:]])
    return df.where(F.col("entity_id").isNotNull()).groupBy("entity_id").agg(F.max_by(value, order).alias("v")).select("entity_id", "v.*")


def entities(*lists: DataFrame) -> DataFrame:
    """Union of source lists as source, num, entity_id, name, address, country."""
    out = None
    for df in lists:
        one = df.select(T.entity_source(F.col("entity_id")).alias("source"), T.entity_number(F.col("entity_id")).alias("num"), "entity_id", F.col("business_name").alias("name"), F.col("business_address").alias("address"), "country")
        out = one if out is None else out.unionByName(one)
    return out


def modulus_sample(df: DataFrame, modulus: int, remainder: int, number: str = "num") -> DataFrame:
    return df if modulus <= 1 else df.where(F.pmod(F.col(number), F.lit(modulus)) == remainder)


def prepared(df: DataFrame) -> DataFrame:
    """source, num, entity_id, country, name_norm, addr_norm and the sets made of them."""
    norm = df.select("source", "num", "entity_id", "country", T.normalize_name(F.col("name")).alias("name_norm"), T.normalize_address(F.col("address")).alias("addr_norm"))
    sets: dict[str, Column] = {
        "name_toks": T.token_set(F.col("name_norm")),
        "addr_toks": T.token_set(F.col("addr_norm")),
        "name_grams": T.byte_trigrams(F.col("name_norm")),
        "addr_grams": T.byte_trigrams(F.col("addr_norm")),
        "addr_nums": T.numeric_tokens(F.col("addr_norm")),
    }
    return norm.withColumns(sets)
