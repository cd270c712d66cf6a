"""What operators need from the Spark session."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per context; they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_weft_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="weft-package-"), "weft.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._weft_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; a folder of our own only where none is set and all runs on one machine (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="weft-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise a plan in the checkpoint folder and cut its lineage there.

    A checkpoint keeps the planner's estimate of its plan, in which arrays and what ``explode`` or Python return count
    for next to nothing; tables of any size would be broadcast through the driver for it. Here the size is unknown
    again, so that only what is measured to be small, after its shuffle, is broadcast.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    done = df.checkpoint(eager=True)._jdf.queryExecution().logical()
    free_shuffles(df)
    none = spark._jvm.scala.Option.empty()
    plan = done.copy(done.output(), done.rdd(), done.outputPartitioning(), done.outputOrdering(), done.isStreaming(), done.stream(), spark._jsparkSession, none, none)
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)


def free_shuffles(df: DataFrame) -> None:
    """Delete the shuffle files of a plan whose rows are written elsewhere; else they stay until the driver happens to collect its garbage."""
    plan = df._jdf.queryExecution().executedPlan()
    cleaner = df.sparkSession._jsc.sc().cleaner()
    if cleaner.isDefined() and plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        for shuffle in list(plan.context().shuffleIds()):
            cleaner.get().doCleanupShuffle(int(shuffle), True)


def _scanned(df: DataFrame) -> DataFrame:
    """The rows of a plan as a source of unknown size. Its shuffles run here and are those of ``df``."""
    spark, none = df.sparkSession, df.sparkSession._jvm.scala.Option.empty()
    query = df._jdf.queryExecution()
    rdd, run = query.toRdd(), query.executedPlan()
    plan = spark._jvm.org.apache.spark.sql.execution.LogicalRDD(query.analyzed().output(), rdd, run.outputPartitioning(), run.outputOrdering(), False, none, spark._jsparkSession, none, none)
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)


def packed(df: DataFrame) -> DataFrame:
    """As ``cut``, in compressed columns: for rows of many words, which a checkpoint writes as they lie in memory."""
    path = shared_path(df.sparkSession, "packed")
    _scanned(df).write.option("compression", "zstd").parquet(path)
    free_shuffles(df)
    out = _scanned(df.sparkSession.read.schema(df.schema).parquet(path))
    out._weft_path = path
    return out


def picked(df: DataFrame, *cols: str) -> DataFrame:
    """Some columns of a frame; of one made by ``packed`` only these are read."""
    path = getattr(df, "_weft_path", None)
    return df.select(*cols) if path is None else _scanned(df.sparkSession.read.schema(df.schema).parquet(path).select(*cols))


def discard(df: DataFrame) -> None:
    """Delete the files of a frame made by ``cut`` or ``packed`` that nothing will read again."""
    spark = df.sparkSession
    folder = getattr(df, "_weft_path", None)
    if folder is None:
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        folder = file.get() if file.isDefined() else None
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder, for what one step of a run writes and the next reads."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
