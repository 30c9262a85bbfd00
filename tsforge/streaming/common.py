"""Shared pieces of the streaming jobs: where they keep state and results, and the result sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tsforge.session import checkpoint_dir


def stream_paths(spark: SparkSession, name: str | None, what: str = "stream") -> tuple[str, str]:
    """(checkpointLocation, output table path) in the shared checkpoint folder. The same ``name``
    gives the same paths in every application, so a restarted job finds its checkpoint and goes on;
    without a name, a new pair is made that no other run uses."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name or what + '-' + uuid.uuid4().hex}"
    return f"{base}/_checkpoint", f"{base}/table"


def epoch_sink(out: str):
    """``foreachBatch`` function that writes each micro-batch to a folder of its own epoch. A
    retried epoch overwrites what its first try left, so no row is written twice."""
    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
    return sink
