"""Structured Streaming over cells: whole rows to RAW, the touched days to CLEAN, counters observed in the same pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from driftline.functions.time import part_of
from driftline.operators.cells import rows_of
from driftline.operators.snapshots import SnapshotTable
from driftline.sources.commits import CommitLog, Taken

COUNTERS = ["cells", "rows", "filtered_rows", "deletes"]


def ingest_cells(
    stream: DataFrame,
    columns: list[str],
    raw_path: str,
    clean: SnapshotTable,
    checkpoint: str,
    counters: CommitLog,
    keys: list[str],
    order: list[str],
    families: list[str] | None = None,
    strict: bool = False,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> StreamingQuery:
    """Put the cells of each micro-batch together to rows (see rows_of()), land and publish them; runs until nothing new is there.

    `shape` turns rows of bytes into typed ones (decode.typed(), decode.keyed()) and must keep `_event_ts`, whose day
    is the row's part. An entry must come whole in one micro-batch; a source of files gives that if each file holds
    whole entries. A batch is computed once: what is written is what is counted. Its rows have folders of their own in
    RAW and its counters the number of the batch, so that a batch which is replayed after a failure replaces the one
    and leaves the other as it is. A day that can't be published fails the batch, which is replayed at the next start.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        cells = batch.where(F.col("family").isin(families)) if strict and families else batch
        passes = F.bool_or(F.col("family").isin(families)) if families else F.bool_or(F.lit(True))
        seen, landed = Observation(), Observation()
        counted = rows_of(cells, columns, more=[passes.alias("_sent")]).observe(
            seen,
            F.coalesce(F.sum("_cells_total"), F.lit(0)).alias("cells"),
            F.count("*").alias("rows"),
            F.count_if(~F.col("_sent")).alias("filtered_rows"),
            F.count_if("_delete").alias("deletes"),
        )
        shaped = shape(counted.where("_sent").drop("_sent"))
        rows = shaped.withColumn("part", part_of(F.timestamp_millis("_event_ts"))).observe(landed, F.collect_set("part").alias("days"))
        out = rows.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
        out.option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch").parquet(raw_path)
        days = sorted(landed.get["days"])
        if days:
            schema = StructType([f for f in rows.schema.fields if f.name != "part"]).add("part", IntegerType())
            raw = batch.sparkSession.read.schema(schema).option("basePath", raw_path).parquet(*(f"{raw_path}/part={d}" for d in days))
            _, failed = clean.publish(raw.drop("batch"), keys, order, days)
            if failed:
                raise RuntimeError(f"batch {batch_id}: days not published: {failed}")
        try:
            counters.put(batch_id, {"batch": batch_id} | {name: seen.get[name] for name in COUNTERS})
        except Taken:
            pass  # a replayed batch: the same cells were counted before

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counted(spark: SparkSession, counters: CommitLog) -> DataFrame:
    """batch, cells, rows, filtered_rows (no cell of the families), deletes (rows with a delete marker): one row for each batch."""
    schema = "batch long, " + ", ".join(f"{c} long" for c in COUNTERS)
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").json(counters.path)
