import os

import pytest
from pyspark.sql import functions as F

from weft.session import cut, discard, ensure_checkpoint_dir


def test_discarded_checkpoints_are_gone(spark):
    df = cut(spark.range(10))
    folder = df._jdf.queryExecution().logical().rdd().getCheckpointFile().get().removeprefix("file:")
    assert df.count() == 10 and os.path.isdir(folder)
    discard(df)
    assert not os.path.exists(folder)


def test_checkpoints_are_not_broadcast_by_estimate(spark):
    """The planner takes an array for one element and exploded rows for one; here either side has 8 MB."""
    long = cut(spark.range(2000).withColumn("x", F.sequence(F.lit(1), F.lit(500))))
    rows = long.select("id", F.explode("x").alias("x"))
    plan = rows.join(long.withColumnRenamed("x", "y"), "id")._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert rows.join(long.select("id"), "id").count() == 1_000_000
    discard(long)


def test_no_folder_of_one_machine_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_written_frames_leave_no_shuffle_files(spark):
    """Shuffle files of a plan that is written are deleted then; else every step of a run adds to the disk."""
    from weft.session import packed, picked

    held = lambda: set(spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keySet().mkString(" ").split())
    before = held()
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id").groupBy("k").agg(F.collect_list("id").alias("v"))
    for write in (cut, packed):
        out = write(df)
        assert held() <= before and out.count() == 7 and out.select(F.explode("v")).count() == 1000
        assert "Broadcast" not in out.join(out.select("k"), "k")._jdf.queryExecution().sparkPlan().toString()
        if write is packed:
            assert picked(out, "k").columns == ["k"] and picked(out, "k").count() == 7
        discard(out)
    assert picked(df, "k").columns == ["k"]
