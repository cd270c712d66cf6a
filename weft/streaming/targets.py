"""Targets that arrive in micro-batches against a static index of master records.

A target's evidence depends on the master records only, so each micro-batch is scored on its own; only
the top-k per master record spans batches. ``score_stream`` appends scored pairs, ``merge_top`` folds a
batch into the standing top-k with the same order as the batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from weft.operators import blocking as B
from weft.operators.records import entities, prepared


def score_batch(master: DataFrame, index: tuple[DataFrame, DataFrame], targets: DataFrame, config: B.BlockingConfig) -> DataFrame:
    """Scored pairs of raw target rows with prepared master records and their ``master_index``."""
    return B.scored_targets(master, index, prepared(entities(targets)), config)


def merge_top(standing: DataFrame | None, scored: DataFrame, config: B.BlockingConfig) -> DataFrame:
    both = scored if standing is None else standing.select(*scored.columns).unionByName(scored)
    return B.top_candidates(both.dropDuplicates(["s1", "source", "num"]), config)


def score_stream(master: DataFrame, targets: DataFrame, config: B.BlockingConfig, path: str, checkpoint: str) -> StreamingQuery:
    """Starts a query that writes the scored pairs of each micro-batch to ``path``/batch=<n>.

    The master records are indexed once, before the first batch. A batch that is repeated after a failure
    overwrites its own folder, so every pair is written once.
    """
    index = B.master_index(master, config)

    def write(batch: DataFrame, number: int) -> None:
        score_batch(master, index, batch, config).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return targets.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
