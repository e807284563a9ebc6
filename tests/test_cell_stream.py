"""Streams of cells that fail, are killed and go on: CLEAN and the counters as of one run over everything."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from driftline.functions import binary
from driftline.operators import decode
from driftline.operators.cells import rows_of
from driftline.operators.dedup import latest_values
from driftline.operators.snapshots import SnapshotTable
from driftline.sources.commits import CommitLog
from driftline.streaming.cells import COUNTERS, counted, ingest_cells

SCHEMA = "entry_id long, rowkey binary, cell_index long, cell_ts long, family string, qualifier string, value binary, is_delete boolean"
DAY = 86_400_000


def typed(rows):
    """A key of four bytes and a long; the rest of a row stays."""
    return decode.typed(decode.keyed(rows, "rowkey", {"k": "UNSIGNED_INT"}), {"n": "UNSIGNED_LONG"}).drop("rowkey")


def cell(spark, rows):
    d = spark.createDataFrame(rows, "entry_id long, k int, cell_index long, cell_ts long, family string, qualifier string, n long, is_delete boolean")
    return d.select(
        "entry_id", binary.big_endian(F.col("k"), 4).alias("rowkey"), "cell_index", "cell_ts", "family", "qualifier",
        F.when(F.col("n").isNotNull(), binary.big_endian(F.col("n"), 8)).alias("value"), "is_delete",
    )


def entries(first, last):
    out = []
    for e in range(first, last):
        for k in range(4):
            at = (e // 6) * DAY + e * 1000 + k
            out.append((e, k, e * 10 + k, at, "d" if (e + k) % 3 else "m", "n", e * 100 + k if (e + k) % 4 else None, (e + k) % 5 == 0))
    return out


@pytest.fixture
def run(spark, tmp_path):
    """Three files of six entries each, and the same stream started again and again."""
    for k in range(3):
        cell(spark, entries(6 * k, 6 * k + 6)).coalesce(1).write.parquet(f"{tmp_path}/drop{k}")
        (part,) = Path(f"{tmp_path}/drop{k}").glob("*.parquet")
        os.makedirs(f"{tmp_path}/cells", exist_ok=True)
        os.rename(part, f"{tmp_path}/cells/{k}.parquet")
        os.utime(f"{tmp_path}/cells/{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    clean, log = SnapshotTable(spark, f"{tmp_path}/clean"), CommitLog(spark, f"{tmp_path}/counters")

    def start(shape=typed, strict=False, families=("m",)):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/cells")
        ingest_cells(stream, ["n"], f"{tmp_path}/raw", clean, f"{tmp_path}/state", log, ["k"], ["entry_id"], list(families), strict, shape).awaitTermination()

    start.clean, start.log, start.path = clean, log, tmp_path
    return start


def expected(spark, cells, strict=False):
    rows = typed(rows_of(cells, ["n"], ["m"], strict)).withColumn("part", (F.date_format(F.timestamp_millis("_event_ts"), "yyyyMMdd")).cast("int"))
    return sorted(map(tuple, latest_values(rows, ["part", "k"], ["entry_id"]).select("part", "k", "n", "_cells_total", "_delete").collect()))


def state(run):
    return sorted(map(tuple, run.clean.read().select("part", "k", "n", "_cells_total", "_delete").collect()))


def totals(spark, run):
    return tuple(counted(spark, run.log).agg(*(F.sum(c) for c in COUNTERS)).first())


def test_killed_and_replayed(spark, run):
    everything = cell(spark, entries(0, 18))
    sent = rows_of(everything, ["n"], ["m"]).count()
    deletes = rows_of(everything, ["n"]).where("_delete").count()
    calls = []

    def fails_second(rows):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return typed(rows)

    with pytest.raises(StreamingQueryException):
        run(fails_second)
    assert state(run) == expected(spark, cell(spark, entries(0, 6))) and run.log.numbers() == [0]
    run()
    assert state(run) == expected(spark, everything)
    assert totals(spark, run) == (72, 72, 72 - sent, deletes)
    # Killed after all was written, before the batch was marked as done: it is replayed and nothing doubles.
    (run.path / "state" / "commits" / "2").unlink()
    (run.path / "state" / "commits" / ".2.crc").unlink(missing_ok=True)
    before = spark.read.parquet(f"{run.path}/raw").count()
    version = run.clean.manifest()["version"]
    run()
    assert run.clean.manifest()["version"] == version + 1, "the batch was replayed"
    assert spark.read.parquet(f"{run.path}/raw").count() == before == sent
    assert state(run) == expected(spark, everything) and totals(spark, run) == (72, 72, 72 - sent, deletes)


def test_day_that_fails_is_replayed(spark, run, monkeypatch):
    publish = SnapshotTable.publish
    monkeypatch.setattr(SnapshotTable, "publish", lambda self, raw, keys, order, parts: ([], parts))
    with pytest.raises(StreamingQueryException):
        run()
    assert run.log.numbers() == []
    monkeypatch.setattr(SnapshotTable, "publish", publish)
    run()
    assert state(run) == expected(spark, cell(spark, entries(0, 18))) and run.log.numbers() == [0, 1, 2]


def test_strict_family(spark, run):
    run(strict=True)
    assert state(run) == expected(spark, cell(spark, entries(0, 18)), strict=True)
    assert counted(spark, run.log).agg(F.sum("filtered_rows")).first()[0] == 0


def test_nothing_passes(spark, run):
    """A batch all of whose rows are filtered is counted and changes no day."""
    run(families=["other"])
    assert totals(spark, run)[:3] == (72, 72, 72) and run.log.numbers() == [0, 1, 2]
    assert run.clean.manifest()["version"] == 0
