"""Queries of problem 5: per-key results under heavy keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators.treeagg import heavy_values, value_profile
from weft.session import table

FIELDS = ("country", "business_name")


def p5_found(spark, sf_dir):
    return heavy_values(table(spark, sf_dir, "train_source1"), FIELDS)


def p5_value_profile(spark, sf_dir):
    v = value_profile(table(spark, sf_dir, "train_source1"), FIELDS, time_col="recorded_at")
    return v.select("field", "key_value", "n_rows", F.round(F.col("n_rows") / F.col("table_rows"), 9).alias("share"), "first_at", "last_at")


QUERIES = {"p5_found": p5_found, "p5_value_profile": p5_value_profile}

_LONG = """
v AS (SELECT 'country' AS field, country AS key_value, recorded_at FROM train_source1
      UNION ALL SELECT 'business_name', business_name, recorded_at FROM train_source1)"""

ORACLE = {
    "p5_found": f"""WITH {_LONG}
        SELECT field, key_value FROM v WHERE key_value IS NOT NULL GROUP BY field, key_value
        HAVING count(*) * 50 > (SELECT count(*) FROM train_source1)""",
    "p5_value_profile": f"""WITH {_LONG}
        SELECT field, key_value, count(*) AS n_rows,
               round(count(*) / (SELECT count(*) FROM train_source1)::double, 9) AS share,
               min(recorded_at) AS first_at, max(recorded_at) AS last_at
        FROM v GROUP BY field, key_value""",
}
