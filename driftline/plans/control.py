"""Queries of how runs are controlled: windows, slices, the journal, waiting partitions."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from driftline.functions import time
from driftline.operators import journal, publish
from driftline.operators.runlog import RunLog
from driftline.operators.snapshots import SnapshotTable
from driftline.plans.queries import PART, WINDOWS, events, query, table, windows
from driftline.sources.folders import shared_folder
from driftline.sources.sliced import database_window
from driftline.sources.window import cast_columns
from driftline.streaming.incremental import catch_up, incremental

NOW = "2024-01-15 00:00:00"


def at(text: str):
    return F.to_timestamp_ntz(F.lit(text))


@query("""SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 1 THEN date_trunc('second', ts) ELSE ts END AS stamp, date_trunc('second', ts) AS seconds,
CASE WHEN event_id % 3 <> 0 THEN user_id END AS number, event_type, CAST(NULL AS VARCHAR) AS missing FROM events""")
def cast_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and numbers as times, texts as whole numbers; another zone than Z, a fraction and an unknown column are null."""
    shape = lambda f: F.date_format("ts", f)
    k = F.col("event_id") % 4
    text = F.when(k == 0, shape("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).when(k == 1, shape("yyyy-MM-dd HH:mm:ss")).when(k == 2, shape(" yyyy-MM-dd HH:mm:ss.SSSSSS ")).otherwise(shape("yyyy-MM-dd HH:mm:ss'+05:00'"))
    seconds = F.floor(time.epoch_us(F.col("ts")) / 1_000_000)
    number = F.when(F.col("event_id") % 3 != 0, F.col("user_id").cast("string")).otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".5")))
    raw = events(spark, sf_dir).select("event_id", text.alias("stamp"), F.when(k < 2, seconds).otherwise(seconds * 1000).alias("seconds"), number.alias("number"), "event_type")
    return cast_columns(raw, ["event_id", "stamp", "seconds", "number", "event_type", "missing"], {"stamp", "seconds"}, {"number"})


def ceil_sql(minutes: int) -> str:
    """user_id, start, end: step by step to the next multiple of the minutes in a day."""
    up = f"date_trunc('day', c) + INTERVAL 1 MINUTE * CAST(ceil((hour(c) * 60 + minute(c)) / {minutes}.0) * {minutes} AS INTEGER)"
    return f"""WITH RECURSIVE r AS (
  SELECT user_id, since AS c, until FROM ({WINDOWS}) WHERE since < until
  UNION ALL SELECT user_id, CASE WHEN {up} <= c THEN c + INTERVAL {minutes} MINUTES ELSE {up} END AS n, until FROM r WHERE n < until
) SELECT user_id, c AS start, coalesce(lead(c) OVER (PARTITION BY user_id ORDER BY c), until) AS end FROM r"""


@query(ceil_sql(20))
def slice_ceil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time.slices_of(windows(spark, sf_dir), 20, "ceil").select("user_id", "start", "end")


@query(ceil_sql(420))
def grid_any_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven hours do not divide the day."""
    return time.slices_of(windows(spark, sf_dir), 420, "ceil").select("user_id", "start", "end")


@query(f"SELECT user_id, CASE WHEN start = min(start) OVER (PARTITION BY user_id) THEN start - INTERVAL 5 MINUTES ELSE start END AS start, \"end\" FROM ({ceil_sql(60)})")
def slice_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the first slice of a window begins earlier."""
    return time.slices_of(windows(spark, sf_dir), 60, "ceil", earlier=5).select("user_id", "start", "end")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a journal: a user is a process, an hour its slice."""
    k = F.col("event_id") % 5
    status = F.when(k < 2, "planned").when(k < 4, "running").otherwise("ok")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return events(spark, sf_dir).select(
        F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("process"), F.col("event_id").alias("run_id"), status.alias("status"), F.col("ts").alias("started_at"),
        hour.alias("slice_start"), (hour + F.make_dt_interval(hours=F.lit(1))).alias("slice_end"), F.when(k == 4, F.col("ts")).alias("ts_end"),
    )


RUNS = "SELECT 'p' || user_id AS process, event_id AS run_id, CASE WHEN event_id % 5 < 2 THEN 'planned' WHEN event_id % 5 < 4 THEN 'running' ELSE 'ok' END AS status, ts AS started_at, date_trunc('hour', ts) AS slice_start, CASE WHEN event_id % 5 = 4 THEN ts END AS ts_end FROM events"
ENDS = f"CASE WHEN goes THEN CASE WHEN status = 'planned' THEN 'skipped' ELSE 'error' END ELSE status END AS status, CASE WHEN goes AND status = 'running' THEN TIMESTAMP '{NOW}' ELSE ts_end END AS ts_end"


@query(f"SELECT run_id, {ENDS} FROM (SELECT *, process = 'p12' AND slice_start = TIMESTAMP '2024-01-01 00:00:00' AND run_id <> 1 AND status <> 'ok' AS goes FROM ({RUNS}))")
def slice_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = journal.without_conflicts(runs(spark, sf_dir), "p12", at("2024-01-01 00:00:00"), at("2024-01-01 01:00:00"), at(NOW), keep=1)
    return out.select("run_id", "status", "ts_end")


@query(f"SELECT process, arg_max(run_id, row(started_at, run_id)) AS run_id FROM ({RUNS}) WHERE status <> 'ok' GROUP BY 1")
def latest_active_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.latest_active(runs(spark, sf_dir))


@query(f"SELECT run_id, {ENDS} FROM (SELECT r.*, r.status <> 'ok' AND r.run_id <> l.run_id AS goes FROM ({RUNS}) r LEFT JOIN (SELECT process, arg_max(run_id, row(started_at, run_id)) AS run_id FROM ({RUNS}) WHERE status <> 'ok' GROUP BY 1) l ON r.process = l.process)")
def one_active_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.one_active(runs(spark, sf_dir), at(NOW)).select("run_id", "status", "ts_end")


@query("SELECT user_id AS process, CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 3 = 1 THEN max(date_trunc('second', ts)) ELSE max(date_trunc('second', ts)) - INTERVAL 5 HOURS END AS watermark FROM events GROUP BY 1")
def watermark_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of windows as text: with Z, with a zone, or no time at all."""
    shape = lambda zone: F.date_format(F.max("ts"), f"yyyy-MM-dd'T'HH:mm:ss'{zone}'")
    k = F.col("user_id") % 3
    state = events(spark, sf_dir).groupBy("user_id").agg(F.when(k == 0, "").when(k == 1, shape("Z")).otherwise(shape("+05:00")).alias("last_ok_end"))
    return journal.watermarks(state.withColumnRenamed("user_id", "process"))


@query("SELECT event_id, 'x' AS a, CASE WHEN event_id % 3 <> 0 THEN event_type ELSE 'old' END AS b, CASE WHEN event_id % 3 <> 0 THEN 'n' END AS c FROM events")
def details_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details merged with news: the new value of b counts, a stays, c comes."""
    old = F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit("old"))
    new = F.when(F.col("event_id") % 3 != 0, F.create_map(F.lit("b"), F.col("event_type"), F.lit("c"), F.lit("n")))
    m = events(spark, sf_dir).select("event_id", journal.merged(old, new).alias("m"))
    return m.select("event_id", *(F.try_element_at("m", F.lit(k)).alias(k) for k in "abc"))


@query("SELECT min(CAST(ts AS DATE))::TIMESTAMP AS since, max(CAST(ts AS DATE))::TIMESTAMP + INTERVAL 1 DAY AS until FROM events")
def part_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.interval_of(events(spark, sf_dir).select(time.part_of(F.col("ts")).alias("part")))


@query(f"SELECT part FROM (SELECT DISTINCT {PART} AS part FROM events WHERE event_type = 'purchase' OR ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09') WHERE part NOT IN (SELECT {PART} FROM events WHERE ts < TIMESTAMP '2024-01-03')")
def pending_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waiting days and those of a window, without those that are published."""
    e = events(spark, sf_dir)
    parts = lambda rows: rows.select(time.part_of(F.col("ts")).alias("part"))
    waiting = publish.pending(parts(e.where("event_type = 'purchase'")), publish.parts_in(e, "ts", "2024-01-05", "2024-01-09"))
    return publish.unpublished(waiting, parts(e.where(F.col("ts") < at("2024-01-03"))))


@query("SELECT topic, name, old, value FROM (SELECT 't' || p_partkey AS topic, 'retention' AS name, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size % 4 AS VARCHAR) END AS old, CAST(p_size % 2 AS VARCHAR) AS value FROM part) WHERE old IS DISTINCT FROM value")
def topic_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("topic"), F.lit("retention").alias("name"))
    value = lambda n: (F.col("p_size") % n).cast("string").alias("value")
    return publish.config_changes(p.select("topic", "name", value(2)), p.where("p_partkey % 3 <> 0").select("topic", "name", value(4)))


WINDOW = "ts >= TIMESTAMP '2024-01-03 05:30:00' AND ts < TIMESTAMP '2024-01-06 12:00:00'"


@query(f"SELECT part, user_id, event_type, arg_max(value, row(ts, event_id)) AS value FROM (SELECT *, {PART} AS part FROM events WHERE {WINDOW}) GROUP BY 1, 2, 3")
def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of events in slices of a day, the first one from 30 minutes before; the result is CLEAN."""
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    slices = time.slices(spark, "2024-01-03 06:00:00", "2024-01-06 12:00:00", 1440)
    source = events(spark, sf_dir).select("user_id", "event_type", "value", "ts", "event_id")
    incremental(source, slices, f"{folder}/raw", f"{folder}/clean", ["user_id", "event_type"], ["ts", "event_id"], "ts", overlap_minutes=30, every=2, least_new=5)
    return spark.read.parquet(f"{folder}/clean").select("part", "user_id", "event_type", "value")


@query("SELECT event_id, ts, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-02 03:17:00' AND ts < TIMESTAMP '2024-01-25 11:00:00'")
def database_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of events behind a database driver; slices of 200 minutes, halved down to 10 minutes where they hold over 5000 rows."""
    folder = f"{shared_folder(spark)}/slices-{uuid.uuid4().hex}"
    events(spark, sf_dir).select("event_id", "ts", "user_id", "value").write.parquet(folder)
    place = folder.removeprefix("file://").removeprefix("file:")
    limits = {"minutes": 200, "least_minutes": 10, "depth": 5, "attempts": 1, "rows": 5000}
    schema = "event_id long, ts timestamp_ntz, user_id long, value double"
    return database_window(spark, schema, "2024-01-02 03:17:00", "2024-01-25 11:00:00", "ts", driver="duckdb", table=f"read_parquet('{place}/*.parquet')", **limits)


@query(f"SELECT part, user_id, event_type, arg_max(value, row(ts, event_id)) AS value, arg_max(event_id, row(ts, event_id)) AS event_id FROM (SELECT *, {PART} AS part FROM events WHERE ts >= TIMESTAMP '2024-01-03 05:45:00' AND ts < TIMESTAMP '2024-01-09 12:00:00') GROUP BY 1, 2, 3")
def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one process; the second goes on at the watermark in the journal. The result is the last snapshot of CLEAN."""
    folder = f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    clean, log = SnapshotTable(spark, f"{folder}/clean"), RunLog(spark, f"{folder}/journal")
    source = events(spark, sf_dir).select("user_id", "event_type", "value", "ts", "event_id", F.col("ts").alias("at"), F.col("event_id").alias("no"))
    for until in (datetime(2024, 1, 6, 9), datetime(2024, 1, 9, 12)):
        catch_up(source, until, 1440, f"{folder}/raw", clean, log, "events", ["user_id", "event_type"], ["at", "no"], "ts", datetime(2024, 1, 3, 6), overlap_minutes=15, every=2)
    return clean.read().select("part", "user_id", "event_type", "value", "event_id")


@query(f"SELECT part, user_id, event_type, arg_max(value, row(ts, event_id)) AS value FROM (SELECT *, {PART} AS part FROM events) WHERE part BETWEEN 20240103 AND 20240120 AND NOT (part = 20240105) GROUP BY 1, 2, 3")
def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days published at once, one of them emptied by a second publication, those before a border dropped by their names."""
    clean = SnapshotTable(spark, f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}")
    e = events(spark, sf_dir).select("user_id", "event_type", "value", F.col("ts").alias("at"), F.col("event_id").alias("no"), time.part_of(F.col("ts")).alias("part"))
    clean.publish(e, ["user_id", "event_type"], ["at", "no"], list(range(20240101, 20240121)))
    clean.publish(e.where("part <> 20240105"), ["user_id", "event_type"], ["at", "no"], [20240105, 20240106])
    clean.drop_before(20240103)
    return clean.read().select("part", "user_id", "event_type", "value")
