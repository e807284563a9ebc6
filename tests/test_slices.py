"""Slices against a step-by-step walk, and the sliced data source with a database that refuses."""

from __future__ import annotations

import sys
import types
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftline.functions import time
from driftline.plans.everything import QUERIES
from driftline.sources import sliced

LO = [datetime(2024, 1, 1, 23, 50), datetime(2024, 1, 1, 1, 10, 30), datetime(2024, 1, 1, 1, 0, 30, 5), datetime(2024, 1, 1), datetime(2023, 12, 31, 23, 59, 59)]


@pytest.mark.parametrize("minutes", [1, 7, 20, 60, 420, 1000, 1439, 1440])
def test_ceil_grid_is_the_walk(spark, minutes):
    for lo in LO[: 3 if minutes in (7, 420) else 1]:
        for hi in (lo, lo + timedelta(minutes=3), lo + timedelta(days=1 if minutes < 7 else 3, seconds=7)):
            want = [(s.start, s.end) for s in sliced.grid(lo, hi, minutes)]
            assert [(r.start, r.end) for r in time.ceil_slices(spark, str(lo), str(hi), minutes).orderBy("start").collect()] == want


def test_grids_begin_at_midnight(spark):
    ends = lambda rows: [f"{r.end:%H:%M}" for r in rows.orderBy("start").collect()]
    assert ends(time.slices(spark, "2024-01-01 01:10:00", "2024-01-02 05:00:00", 420, grid=True)) == ["07:00", "14:00", "21:00", "04:00", "05:00"]
    assert ends(time.ceil_slices(spark, "2024-01-01 23:50:00", "2024-01-02 00:10:00", 7)) == ["23:55", "00:02", "00:07", "00:10"]
    assert ends(time.slices(spark, "2024-01-01", "2024-01-01 00:10:00", 0)) == ["00:10"]
    slot = spark.sql("SELECT timestamp_ntz'2024-01-02 13:59:00' AS t").select(time.grid_slot(F.col("t"), 420).alias("s")).first().s
    assert slot == datetime(2024, 1, 2, 7)
    empty = spark.sql("SELECT CAST(NULL AS timestamp_ntz) AS since, timestamp_ntz'2024-01-02' AS until")
    assert time.slices_of(empty, 5, "ceil").count() == 0


def test_slices_of_grouped_windows_are_made_in_several_tasks(spark):
    """A table of few windows is left in one task by Spark; its slices are not, and nothing behind them gathers them again."""
    query = QUERIES["slice_overlap"](spark, "/root/testdata/sf0.01")
    rows = query.groupBy(F.spark_partition_id()).count().collect()
    assert len(rows) == 4 and max(r["count"] for r in rows) < 0.5 * sum(r["count"] for r in rows)
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


@pytest.mark.parametrize("grid", ["start", "floor", "ceil"])
def test_the_first_slice_of_each_window_begins_earlier(spark, grid):
    windows = spark.createDataFrame([(k, lo, lo + timedelta(hours=k)) for k, lo in enumerate(LO)], "k int, since timestamp_ntz, until timestamp_ntz")
    got = time.slices_of(windows, 60, grid, earlier=5).select("k", "start", "end").collect()
    assert sorted(got) == sorted(time.overlapped(time.slices_of(windows, 60, grid).select("k", "start", "end"), 5, ["k"]).collect())
    assert {r.k: r.end for r in got if r.start == LO[r.k] - timedelta(minutes=5)}.keys() == set(range(1, len(LO)))


def refusing(most: timedelta, fails: int = 0):
    tried = []

    def fetch(a, b):
        tried.append((a, b))
        if b - a > most or len(tried) <= fails:
            raise RuntimeError("org.apache.JobManager: task REJECTED")
        return [(a, b)]

    return fetch, tried


def test_a_refused_slice_is_halved():
    a = datetime(2024, 1, 1)
    fetch, _ = refusing(timedelta(minutes=20))
    got = list(sliced.pull(fetch, sliced.Slice(a, a + timedelta(minutes=160)), sliced.Limits(least_minutes=5, depth=3)))
    assert got == [(a + timedelta(minutes=20 * k), a + timedelta(minutes=20 * k + 20)) for k in range(8)]


def test_what_cannot_be_halved_waits_and_fails_at_last():
    a, waits = datetime(2024, 1, 1), []
    one = sliced.Slice(a, a + timedelta(minutes=2))
    fetch, tried = refusing(timedelta(hours=1), fails=2)
    assert list(sliced.pull(fetch, one, sliced.Limits(wait=8), sleep=waits.append)) == [(one.start, one.end)]
    assert len(tried) == 3 and 8 <= waits[0] <= 10 and 16 <= waits[1] <= 18
    fetch, tried = refusing(timedelta(0))
    with pytest.raises(RuntimeError):
        list(sliced.pull(fetch, one, sliced.Limits(attempts=4), sleep=waits.append))
    assert len(tried) == 4
    with pytest.raises(ZeroDivisionError):
        list(sliced.pull(lambda *_: 1 / 0, one, sliced.Limits()))


def test_bounds_reach_the_source_and_all_rows_come(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.select("event_id", "ts").write.parquet(f"{tmp_path}/e")
    options = {"driver": "duckdb", "table": f"read_parquet('{tmp_path}/e/*.parquet')", "minutes": 1440, "least_minutes": 1, "depth": 12, "attempts": 1, "rows": 7}
    got = sliced.database_window(spark, "event_id long, ts timestamp_ntz", "2024-01-03 05:00:00", "2024-01-20 12:34:56.789", "ts", **options)
    want = e.where("ts >= timestamp_ntz'2024-01-03 05:00:00' AND ts < timestamp_ntz'2024-01-20 12:34:56.789'").select("event_id", "ts")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.rdd.getNumPartitions() == 18
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Filter (((" not in plan and "ts >= " not in plan.split("BatchScan")[0]
    with pytest.raises(Exception, match="both bounds"):
        spark.read.format("time_slices").schema("event_id long, ts timestamp_ntz").options(ts="ts", **{k: str(v) for k, v in options.items()}).load().collect()


def test_a_driver_is_named_by_module_and_function(monkeypatch):
    calls = []
    module = types.ModuleType("some_driver")
    module.open = lambda **k: calls.append(k)
    monkeypatch.setitem(sys.modules, "some_driver", module)
    sliced.Database("some_driver:open", {"host": "x"}, "t", "at", ["a", 'b"c'], 0, 10)
    assert calls == [{"host": "x"}]
