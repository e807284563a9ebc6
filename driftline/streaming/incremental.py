"""A run over the slices of a window: each slice to RAW, touched days to CLEAN now and then, all of them at the end."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import IntegerType, StructType

from driftline.functions.time import overlapped, part_of
from driftline.operators.publish import publish
from driftline.operators.runlog import RunLog
from driftline.operators.snapshots import SnapshotTable
from driftline.sources.sliced import grid
from driftline.sources.window import window


def incremental(
    source: DataFrame,
    slices: DataFrame,
    raw_path: str,
    clean_path: str,
    keys: list[str],
    order: list[str],
    ts: str,
    overlap_minutes: int = 0,
    every: int = 3,
    least_new: int = 1,
) -> DataFrame:
    """Read each slice (start, end) of source to RAW and publish; returns what was published: slice_no, part.

    The first slice begins `overlap_minutes` earlier. After every `every` slices the waiting days with at least
    `least_new` new rows are published, at the end all that wait. A slice has a folder of its own in RAW, so one that
    is run again after a failure replaces its rows. Only the list of slices and the days they touched reach the driver.
    """
    spark, columns = source.sparkSession, source.columns
    plan = overlapped(slices, overlap_minutes).orderBy("start", "end").collect()
    fresh: dict[int, int] = {}
    done: list[tuple[int, int]] = []

    def send(no: int, parts: list[int]) -> None:
        if parts:
            publish(_raw(source, raw_path, parts), clean_path, keys, order, parts)
            done.extend((no, p) for p in parts)
            for p in parts:
                del fresh[p]

    for no, (start, end) in enumerate(((r["start"], r["end"]) for r in plan), 1):
        name = f"{start:%Y%m%d%H%M%S%f}"
        days = _land(window(source, ts, columns, str(start), str(end)), ts, raw_path, f"s{name}")
        if days:  # the folders of this slice alone; a count needs their footers only
            there = _raw(source, raw_path, days, f"/slice=s{name}")
            for r in there.groupBy("part").count().collect():
                fresh[r["part"]] = fresh.get(r["part"], 0) + r["count"]
        if every > 0 and no % every == 0:
            send(no, sorted(p for p, n in fresh.items() if n >= least_new))
    send(len(plan), sorted(fresh))
    return spark.createDataFrame(done, "slice_no int, part int")


def _land(rows: DataFrame, ts: str, raw_path: str, name: str) -> list[int]:
    """Write rows to the folders of their days and of this slice in RAW; the days, observed in the same pass."""
    seen = Observation()
    found = rows.withColumn("part", part_of(F.col(ts))).withColumn("slice", F.lit(name))
    found.observe(seen, F.collect_set("part").alias("days")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "slice").parquet(raw_path)
    return sorted(seen.get["days"])


def _raw(source: DataFrame, raw_path: str, parts: list[int], inner: str = "") -> DataFrame:
    """RAW's rows of these days; no folder of another day is listed."""
    schema = StructType(list(source.schema.fields)).add("part", IntegerType())
    return source.sparkSession.read.schema(schema).option("basePath", raw_path).parquet(*(f"{raw_path}/part={p}{inner}" for p in parts))


def catch_up(
    source: DataFrame,
    until: datetime,
    minutes: int,
    raw_path: str,
    clean: SnapshotTable,
    journal: RunLog,
    process: str,
    keys: list[str],
    order: list[str],
    ts: str,
    since: datetime | None = None,
    overlap_minutes: int = 0,
    every: int = 3,
) -> str:
    """Go on where the process stands, up to `until`: slices to RAW, days to CLEAN, all of it in the journal; returns the run.

    It begins at the end of the last slice that is in RAW, whether its run went well, failed or died; `since` is for the
    first run of all. Busy if a run of the process is active. The first slice reads `overlap_minutes` before that again.
    A slice has its own folders in RAW and the journal knows it only when it is there, so what a dead run left half
    done is written again. Days wait in the journal until a snapshot of CLEAN has them: after `every` slices and at the
    end. A day that can't be published waits for the next run; the run goes well all the same.
    """
    begin, _ = journal.done_until(process)
    begin = begin or since
    if begin is None:
        raise ValueError(f"{process} has no watermark; the first run needs since")
    run = journal.start(process, begin, max(begin, until))
    try:
        for no, part in enumerate(grid(begin, until, minutes), 1):
            start = part.start - timedelta(minutes=overlap_minutes if no == 1 else 0)
            days = _land(window(source, ts, source.columns, str(start), str(part.end)), ts, raw_path, f"s{start:%Y%m%d%H%M%S%f}")
            journal.slice_done(run, part.start, part.end, days)
            if every > 0 and no % every == 0:
                _send(source, raw_path, clean, journal, process, run, keys, order)
        _send(source, raw_path, clean, journal, process, run, keys, order)
        journal.finish(run)
    except Exception as e:
        journal.fail(run, str(e)[:500])
        raise
    return run


def _send(source: DataFrame, raw_path: str, clean: SnapshotTable, journal: RunLog, process: str, run: str, keys: list[str], order: list[str]) -> None:
    """Publish the days that wait."""
    _, waiting = journal.done_until(process)
    if waiting:
        done, _ = clean.publish(_raw(source, raw_path, waiting), keys, order, waiting)
        journal.published(run, done)


def republish(source: DataFrame, raw_path: str, clean: SnapshotTable, keys: list[str], order: list[str], parts: list[int]) -> tuple[list[int], list[int]]:
    """Publish days anew from RAW, whatever the journal says; a day that RAW has no folder of is emptied."""
    there = {int(n.removeprefix("part=")) for n in clean.log.folders(raw_path) if n.startswith("part=")}
    found = [p for p in parts if p in there]
    schema = StructType(list(source.schema.fields)).add("part", IntegerType())
    raw = _raw(source, raw_path, found) if found else source.sparkSession.createDataFrame([], schema)
    return clean.publish(raw, keys, order, parts)
