"""The keyed upsert over a stream: each micro-batch makes the next snapshot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import upsert_table


def snapshot_path(folder: str, version: int) -> str:
    return f"{folder}/v={version}"


def stream_upserts(changes: DataFrame, table: str, folder: str, checkpoint: str, on_snapshot: Callable[[str], None] | None = None) -> StreamingQuery:
    """Applies changes in batches: version n is written from version n - 1, so a batch that is replayed writes the same snapshot."""

    def apply(batch: DataFrame, version: int) -> None:
        session = batch.sparkSession
        target = session.read.parquet(snapshot_path(folder, version - 1)) if version else None
        upsert_table(table, target, batch).write.mode("overwrite").parquet(snapshot_path(folder, version))
        if on_snapshot:
            on_snapshot(snapshot_path(folder, version))

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
