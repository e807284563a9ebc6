"""Structured Streaming: cells or rows to RAW, then the touched days to CLEAN."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from driftline.functions.time import part_of
from driftline.operators.publish import publish


def ingest(stream: DataFrame, raw_path: str, clean_path: str, checkpoint: str, keys: list[str], order: list[str], ts: str) -> StreamingQuery:
    """Write each micro-batch to RAW and publish the day partitions it touched; runs until nothing new is there.

    RAW is partitioned by part and batch: a replayed batch replaces its own folders, so nothing is doubled. A batch is
    computed once; its days, a small number, are read from what was written.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("part", part_of(F.col(ts))).withColumn("batch", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch").parquet(raw_path)
        raw = batch.sparkSession.read.parquet(raw_path)
        parts = [r["part"] for r in raw.where(F.col("batch") == batch_id).select("part").distinct().collect()]
        if parts:
            publish(raw.drop("batch"), clean_path, keys, order, parts)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
