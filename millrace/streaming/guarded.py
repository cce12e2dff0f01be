"""A guarded sink for micro-batches: each batch is one attempt to refresh, and the last good state survives bad ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from millrace.operators import guards, snapshots


def guarded_sink(root: str, source: str) -> Callable[[DataFrame, int], None]:
    """For writeStream.foreachBatch: merges a batch with the published snapshot by source and publishes the result.

    There is nothing to hold the first batch against; it must have rows, or nothing is published."""

    def write(batch: DataFrame, epoch: int) -> None:
        before = snapshots.read_last_good(batch.sparkSession, root)
        if before is None and batch.isEmpty():
            return
        rows = batch if before is None else guards.last_good(before, batch, source).drop("served_from_previous")
        name = f"v{epoch}"
        if snapshots.published(batch.sparkSession, root) != name:  # a batch that is run again isn't published twice
            rows.write.mode("overwrite").parquet(f"{root}/{name}")
            snapshots.publish(batch.sparkSession, root, name, epoch)

    return write
