"""Snapshots, the durable journal, and runs that stop half way."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftline.operators import runlog, snapshots
from driftline.operators.runlog import Busy, RunLog
from driftline.operators.snapshots import Conflict, SnapshotTable
from driftline.sources.commits import CommitLog, Taken
from driftline.streaming import incremental

T = datetime(2024, 1, 1)


def raw(spark, rows):
    return spark.createDataFrame(rows, "part int, k int, v string, at int")


def table_of(t):
    return sorted((r.part, r.k, r.v) for r in t.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "clean"))
    t.publish(raw(spark, [(1, 1, "a", 1), (1, 1, "b", 2), (1, 2, None, 3), (2, 1, "c", 1)]), ["k"], ["at"], [1, 2, 3])
    return t


def test_a_number_is_written_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    log.put(1, {"a": "é"})
    with pytest.raises(Taken):
        log.put(1, {"a": 2})
    assert log.numbers() == [1] and log.get(1) == {"a": "é"}
    with ThreadPoolExecutor(8) as pool:

        def one(k):
            try:
                log.put(2, {"k": k})
                return k
            except Taken:
                return None

        won = [k for k in pool.map(one, range(8)) if k is not None]
    assert log.get(2)["k"] in won


def test_publication_replaces_and_empties_days(spark, table):
    assert table_of(table) == [(1, 1, "b"), (1, 2, None), (2, 1, "c")]
    before = table.read()
    assert table.publish(raw(spark, [(2, 9, "z", 1)]), ["k"], ["at"], [1, 2]) == ([1, 2], [])
    assert table_of(table) == [(2, 9, "z")]
    assert sorted((r.part, r.k) for r in before.collect()) == [(1, 1), (1, 2), (2, 1)]  # who read before goes on reading that
    assert table.read(1).count() == 3
    assert table.publish(raw(spark, []), ["k"], ["at"], []) == ([], [])


def test_a_run_stopped_before_the_manifest_changes_nothing(spark, table, monkeypatch):
    monkeypatch.setattr(table, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        table.publish(raw(spark, [(1, 5, "new", 1), (2, 5, "new", 1)]), ["k"], ["at"], [1, 2])
    assert table_of(table) == [(1, 1, "b"), (1, 2, None), (2, 1, "c")]
    monkeypatch.undo()
    assert len(table.vacuum(keep=1)) == 1 and table_of(table) == [(1, 1, "b"), (1, 2, None), (2, 1, "c")]


def test_a_day_that_fails_leaves_the_others(spark, table):
    bad = raw(spark, [(1, 5, "new", 1), (2, 5, "bad", 1), (3, 5, "new", 1)]).withColumn("v", F.when(F.col("v") == "bad", F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("string"))
    assert table.publish(bad, ["k"], ["at"], [1, 2, 3]) == ([1, 3], [2])
    assert table_of(table) == [(1, 5, "new"), (2, 1, "c"), (3, 5, "new")]


def test_two_publications_at_once(spark, table, monkeypatch):
    other, stage = SnapshotTable(spark, table.path), table._stage

    def between(day):
        def staged(rows, keys):
            out = stage(rows, keys)
            other.publish(raw(spark, [(day, 7, "other", 1)]), ["k"], ["at"], [day])
            return out

        return staged

    monkeypatch.setattr(table, "_stage", between(2))
    table.publish(raw(spark, [(1, 5, "mine", 1)]), ["k"], ["at"], [1])
    assert table_of(table) == [(1, 5, "mine"), (2, 7, "other")]
    monkeypatch.setattr(table, "_stage", between(1))
    with pytest.raises(Conflict):
        table.publish(raw(spark, [(1, 6, "mine", 1)]), ["k"], ["at"], [1])
    assert table_of(table) == [(1, 7, "other"), (2, 7, "other")]


def test_old_days_and_spent_folders_go(spark, table):
    assert table.drop_before(2) == [1] and table.drop_before(2) == []
    assert table_of(table) == [(2, 1, "c")]
    gone = table.vacuum(keep=1)
    assert len(gone) == 1 and gone[0].endswith("part=1")
    assert table_of(table) == [(2, 1, "c")] and table.vacuum(keep=1) == []
    with pytest.raises(FileNotFoundError):
        SnapshotTable(spark, table.path + "x").read()


class Clock:
    def __init__(self):
        self.now = T

    def __call__(self):
        return self.now


@pytest.fixture
def log(spark, tmp_path):
    return RunLog(spark, str(tmp_path / "journal"), Clock())


def test_one_run_of_a_process_at_a_time(log):
    run = log.start("p", T, T + timedelta(hours=1))
    with pytest.raises(Busy):
        log.start("p", T, T + timedelta(hours=1))
    log.start("q", T, T)
    log.finish(run)
    assert log.watermark("p") == T + timedelta(hours=1) and log.watermark("q") is None
    with pytest.raises(ValueError):
        log.finish(run)
    log.finish(log.start("p", T - timedelta(days=1), T - timedelta(hours=3)))
    assert log.watermark("p") == T + timedelta(hours=1)  # an older window does not set it back


def test_of_many_that_start_at_once_one_begins(spark, log):
    def one(_):
        try:
            return RunLog(spark, log.log.path, log.clock).start("p", T, T)
        except Busy:
            return None

    with ThreadPoolExecutor(6) as pool:
        assert sum(r is not None for r in pool.map(one, range(6))) == 1


def test_a_silent_run_is_dead(log):
    first = log.start("p", T, T + timedelta(hours=1))
    log.clock.now += timedelta(minutes=runlog.SILENT)
    with pytest.raises(Busy):
        log.start("p", T, T)
    log.beat(first)
    log.clock.now += timedelta(minutes=runlog.SILENT, seconds=1)
    second = log.start("p", T, T)
    assert {r.run: r.status for r in log.runs().collect()} == {first: "error", second: "running"}


def test_the_journal_is_the_same_after_it_was_compacted(log, monkeypatch):
    monkeypatch.setattr(runlog, "COMPACT", 5)
    monkeypatch.setattr(runlog, "KEPT", 2)
    for k in range(6):
        run = log.start("p", T, T + timedelta(hours=k))
        log.slice_done(run, T, T + timedelta(hours=k), [20240101 + k])
        log.published(run, [20240101 + k]) if k % 2 else None
        log.finish(run)
    assert log.done_until("p") == (T + timedelta(hours=5), [20240101, 20240103, 20240105])
    assert len(log.log.numbers()) < 20 and log.runs().count() < 6 and log.start("p", T, T) == "p-7"


def test_a_run_killed_in_a_slice_goes_on_there(spark, log, tmp_path, monkeypatch):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "value", "ts", F.col("ts").alias("at"), F.col("event_id").alias("no"))
    clean, land, read = SnapshotTable(spark, str(tmp_path / "clean")), incremental._land, []
    since, until = datetime(2024, 1, 3, 5), datetime(2024, 1, 9, 7)

    def run():
        return incremental.catch_up(e, until, 1440, str(tmp_path / "raw"), clean, log, "p", ["user_id"], ["at", "no"], "ts", since, every=2)

    def dies(rows, ts, path, name):
        read.append(name)
        if len(read) == 4:
            land(rows.limit(3), ts, path, name)  # half of it is written
            raise SystemExit  # as a killed driver: nothing is written to the journal
        return land(rows, ts, path, name)

    monkeypatch.setattr(incremental, "_land", dies)
    with pytest.raises(SystemExit):
        run()
    assert set(map(str, clean.manifest()["parts"])) == {"20240103", "20240104"}
    with pytest.raises(Busy):
        run()
    log.clock.now += timedelta(hours=1)
    run()
    assert read[3] == read[4] and len(read) == 8
    want = e.where((F.col("ts") >= F.lit(since).cast("timestamp_ntz")) & (F.col("ts") < F.lit(until).cast("timestamp_ntz"))).withColumn("part", F.date_format("ts", "yyyyMMdd").cast("int"))
    want = want.groupBy("part", "user_id").agg(F.max_by("value", F.struct("at", "no")).alias("value"))
    got = clean.read().select("part", "user_id", "value")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert log.watermark("p") == until and log.done_until("p") == (until, [])
    assert incremental.republish(e, str(tmp_path / "raw"), clean, ["user_id"], ["at", "no"], [20240104, 20250101]) == ([20240104, 20250101], [])
    assert sorted(map(tuple, clean.read().select("part", "user_id", "value").collect())) == sorted(map(tuple, want.collect()))


def test_a_first_run_needs_a_beginning(spark, log, tmp_path):
    with pytest.raises(ValueError):
        incremental.catch_up(spark.range(1), T, 60, "", SnapshotTable(spark, str(tmp_path / "c")), log, "p", [], [], "ts")
    assert snapshots.json_of(spark.range(1).schema)["fields"][0]["name"] == "id"
