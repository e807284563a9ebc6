"""Queries on the driver's tables, one for each operator, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from driftline.functions import binary, naming, time
from driftline.operators import cells, journal, publish, serialize
from driftline.operators.dedup import latest_values
from driftline.operators.snapshots import SnapshotTable
from driftline.sources.commits import CommitLog
from driftline.sources.folders import shared_folder
from driftline.sources.window import window
from driftline.streaming.cells import counted, ingest_cells
from driftline.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a keyed history with gaps: a value or props is missing now and then."""
    e = events(spark, sf_dir).withColumn("part", time.part_of(F.col("ts")))
    return e.withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value"))).withColumn("props", F.when(F.col("event_id") % 5 != 0, F.col("props")))


PART = "CAST(strftime(ts, '%Y%m%d') AS INTEGER)"
HISTORY = f"SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value, CASE WHEN event_id % 5 <> 0 THEN props END AS props, {PART} AS part FROM events"
KEYS = ["part", "user_id", "event_type"]


@query("SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-07 12:30:00'")
def window_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window(events(spark, sf_dir), "ts", ["event_id", "ts", "value"], "2024-01-05 00:00:00", "2024-01-07 12:30:00")


@query(f"SELECT {PART} AS part, count(*) AS n_rows FROM events GROUP BY 1")
def part_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy(time.part_of(F.col("ts")).alias("part")).agg(F.count("*").alias("n_rows"))


@query(f"SELECT DISTINCT {PART} AS part FROM events WHERE ts >= TIMESTAMP '2024-01-03 10:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00'")
def distinct_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.parts_in(events(spark, sf_dir), "ts", "2024-01-03 10:00:00", "2024-01-09")


@query(f"SELECT part, user_id, event_type, arg_max(event_id, row(ts, event_id)) AS event_id, arg_max(ts, row(ts, event_id)) AS ts, arg_max(value, row(ts, event_id)) AS value, arg_max(props, row(ts, event_id)) AS props FROM ({HISTORY}) GROUP BY 1, 2, 3")
def dedup_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_values(history(spark, sf_dir).withColumn("at", F.col("ts")).withColumn("no", F.col("event_id")), KEYS, ["at", "no"]).drop("at", "no")


@query(f"SELECT user_id, event_type, arg_max(value, row(part, event_id)) AS value, arg_max(props, row(part, event_id)) AS props FROM ({HISTORY}) GROUP BY 1, 2")
def dedup_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir).select("user_id", "event_type", "value", "props", F.col("part").alias("at"), F.col("event_id").alias("no"))
    return latest_values(rows, ["user_id", "event_type"], ["at", "no"]).drop("at", "no")


@query("SELECT time_bucket(INTERVAL 10 MINUTES, ts, TIMESTAMP '2024-01-01') AS slot, count(*) AS n_rows, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def slice_grid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy(time.grid_slot(F.col("ts"), 10).alias("slot")).agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("users"))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the first to the last event of each user."""
    return events(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("since"), F.max("ts").alias("until"))


WINDOWS = "SELECT user_id, min(ts) AS since, max(ts) AS until FROM events GROUP BY 1"


@query(f"SELECT user_id, s AS start, least(s + INTERVAL 7 HOURS, until) AS end FROM (SELECT *, unnest(range(since, until, INTERVAL 7 HOURS)) AS s FROM ({WINDOWS}))")
def slice_tail_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time.slices_of(windows(spark, sf_dir), 420).select("user_id", "start", "end")


@query(f"SELECT user_id, greatest(s, since) AS start, least(s + INTERVAL 7 HOURS, until) AS end FROM (SELECT *, unnest(range(date_trunc('day', since) + INTERVAL 7 HOURS * CAST(floor(hour(since) / 7) AS INTEGER), until, INTERVAL 7 HOURS)) AS s FROM ({WINDOWS}))")
def slice_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven hours do not divide the day: the grid is counted from the first midnight."""
    return time.slices_of(windows(spark, sf_dir), 420, "floor").select("user_id", "start", "end")


@query("SELECT event_id, CAST(DATE '1970-01-05' + CAST(floor((CAST(ts AS DATE) - DATE '1970-01-05') / 14.0) * 14 AS INTEGER) AS DATE) AS first_day FROM events")
def interval_floor_monday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", time.floor_days(F.col("ts"), 14).alias("first_day"))


@query("SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_ms FROM events")
def ts_ms_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", time.floor_ms(F.col("ts")).alias("ts_ms"))


@query("SELECT event_id, CASE WHEN v > 10000000000 THEN make_timestamp(v * 1000) ELSE make_timestamp(v * 1000000) END AS stamp FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) // 1000000 END AS v FROM events)")
def epoch_sec_or_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    us = time.epoch_us(F.col("ts"))
    v = F.when(F.col("event_id") % 2 == 0, F.floor(us / 1000)).otherwise(F.floor(us / 1_000_000))
    return events(spark, sf_dir).select("event_id", time.from_epoch_any(v).alias("stamp"))


@query("SELECT event_id, CASE event_id % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 2 THEN date_trunc('second', ts) - INTERVAL 5 HOURS ELSE date_trunc('second', ts) END AS stamp FROM events")
def parse_ts_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = lambda f: F.date_format("ts", f)
    k = F.col("event_id") % 5
    s = F.when(k == 0, shape("yyyy-MM-dd HH:mm:ss")).when(k == 1, F.concat(shape("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(k == 2, F.concat(shape("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))).when(k == 3, F.lit("  "))
    return events(spark, sf_dir).select("event_id", time.from_text(s.otherwise(F.lit("no date"))).alias("stamp"))


@query("SELECT event_id, CAST(ts + CASE WHEN ts < TIMESTAMP '2024-02-29 18:00:00' THEN INTERVAL 6 HOURS ELSE INTERVAL 5 HOURS END AS DATE) AS local_day FROM events")
def local_date_almaty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", time.local_date(F.col("ts"), "Asia/Almaty").alias("local_day"))


@query(f"SELECT {PART} AS part, count(*) AS n_rows FROM events WHERE event_type <> 'purchase' GROUP BY 1 HAVING count(*) >= 20")
def gated_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = events(spark, sf_dir).where(F.col("event_type") != "purchase").withColumn("part", time.part_of(F.col("ts")))
    return publish.gated(new, 20)


LOCAL = "{0} + CASE WHEN {0} < TIMESTAMP '2024-02-29 18:00:00' THEN INTERVAL 6 HOURS ELSE INTERVAL 5 HOURS END"  # the zone's offset changed then


@query(f"SELECT user_id, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS part FROM (SELECT user_id, unnest(range(CAST({LOCAL.format('since')} AS DATE), CAST({LOCAL.format('until')} - INTERVAL 1 MILLISECOND AS DATE) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM ({WINDOWS}) WHERE since < until)")
def backfill_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time.days_of(windows(spark, sf_dir), "Asia/Almaty").select("user_id", "part")


@query(f"WITH h AS ({HISTORY}) SELECT part, user_id, event_type, value FROM (SELECT part, user_id, event_type, arg_max(value, row(ts, event_id)) AS value FROM h WHERE event_id % 2 = 0 GROUP BY 1, 2, 3) WHERE part NOT BETWEEN 20240105 AND 20240107 UNION ALL SELECT part, user_id, event_type, arg_max(value, row(ts, event_id)) FROM h WHERE part BETWEEN 20240105 AND 20240107 GROUP BY 1, 2, 3")
def publish_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir).select(*KEYS, "value", F.col("ts").alias("at"), F.col("event_id").alias("no"))
    old, new = (latest_values(x, KEYS, ["at", "no"]).drop("at", "no") for x in (h.where("no % 2 = 0"), h.where("part between 20240105 and 20240107")))
    parts = spark.range(20240105, 20240108).select(F.col("id").cast("int").alias("part"))
    return publish.replaced(old, new, parts)


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-25 12:00:00' - INTERVAL 5 DAYS")
def retention_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.retained(events(spark, sf_dir), "ts", "2024-01-25 12:00:00", 5).select("event_id", "ts")


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as cells: an entry holds 50 events, a row is a user and type in it."""
    e = events(spark, sf_dir).withColumn("key", F.concat_ws("|", F.col("user_id").cast("string"), "event_type"))
    cell = lambda i, family, q, v, gone: F.struct(F.lit(i).alias("i"), F.lit(family).alias("family"), F.lit(q).alias("qualifier"), v.alias("value"), gone.alias("is_delete"))
    no = F.lit(False)
    listed = F.array(cell(0, "d", "value", F.when(F.col("event_id") % 7 != 0, F.floor("value").cast("string")), no), cell(1, "m", "props", F.col("props"), F.col("event_id") % 11 == 0))
    rows = e.select(F.floor(F.col("event_id") / 50).alias("entry_id"), F.col("key").cast("binary").alias("rowkey"), "event_id", F.floor(time.epoch_us(F.col("ts")) / 1000).alias("cell_ts"), F.explode(listed).alias("c"))
    rows = rows.where((F.col("c.family") == "d") | (F.col("event_id") % 3 == 0))
    return rows.select("entry_id", "rowkey", (F.col("event_id") * 2 + F.col("c.i")).alias("cell_index"), "cell_ts", "c.family", "c.qualifier", "c.value", "c.is_delete")


CELLS = """SELECT event_id // 50 AS entry_id, user_id || '|' || event_type AS rowkey, event_id * 2 AS cell_index, epoch_us(ts) // 1000 AS cell_ts, 'd' AS family, 'value' AS qualifier, CASE WHEN event_id % 7 <> 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS value, false AS is_delete FROM events
UNION ALL SELECT event_id // 50, user_id || '|' || event_type, event_id * 2 + 1, epoch_us(ts) // 1000, 'm', 'props', props, event_id % 11 = 0 FROM events WHERE event_id % 3 = 0"""
ROWS = "SELECT entry_id, rowkey, arg_max(value, cell_index) FILTER (qualifier = 'value' AND NOT is_delete) AS value, arg_max(value, cell_index) FILTER (qualifier = 'props' AND NOT is_delete) AS props, count(*) AS _cells_total, max(cell_ts) AS _event_ts, bool_or(is_delete) AS _delete"


@query(f"{ROWS} FROM ({CELLS}) GROUP BY 1, 2")
def cells_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.rows_of(event_cells(spark, sf_dir), ["value", "props"]).withColumn("rowkey", F.col("rowkey").cast("string"))


@query(f"{ROWS} FROM ({CELLS}) GROUP BY 1, 2 HAVING bool_or(family = 'm')")
def cf_any_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.rows_of(event_cells(spark, sf_dir), ["value", "props"], ["m"]).withColumn("rowkey", F.col("rowkey").cast("string"))


@query(f"SELECT count(DISTINCT entry_id) AS entries, count(*) AS rows, CAST(sum(cells) AS BIGINT) AS cells, CAST(sum(CASE WHEN passes THEN 0 ELSE 1 END) AS BIGINT) AS filtered_rows FROM (SELECT entry_id, rowkey, count(*) AS cells, bool_or(family = 'm') AS passes FROM ({CELLS}) GROUP BY 1, 2)")
def wal_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.metrics(event_cells(spark, sf_dir), ["m"])


@query("SELECT c_custkey, lower(hex(c_name)) AS key_hex, to_base64(encode(c_name)) AS key_base64, substr(c_name, 3) AS unsalted FROM customer")
def rowkey_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_name").cast("binary")
    return table(spark, sf_dir, "customer").select("c_custkey", binary.hex_lower(key).alias("key_hex"), F.base64(key).alias("key_base64"), binary.without_salt(key, 2).cast("string").alias("unsalted"))


@query(r"SELECT s_suppkey, regexp_replace(regexp_replace(regexp_replace('cdc.' || 'ns' || s_nationkey || '_' || s_name, '^[._-]+', ''), '__+', '_', 'g'), '[^a-zA-Z0-9._-]', '_', 'g') AS topic, regexp_replace('ns' || s_nationkey || ':' || s_name || '-value', '[^a-zA-Z0-9._-]', '_', 'g') AS subject FROM supplier")
def topic_and_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    ns = F.concat(F.lit("ns"), F.col("s_nationkey").cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", naming.topic("cdc.${table}", ns, F.col("s_name")).alias("topic"), naming.subject(ns, F.col("s_name")).alias("subject"))


@query("SELECT o_orderkey, '00' || printf('%08X', CAST(o_orderkey AS BIGINT)) || hex(o_orderpriority) AS frame FROM orders")
def confluent_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.hex(binary.confluent_frame(F.col("o_orderkey"), F.col("o_orderpriority").cast("binary"))).alias("frame"))


@query("SELECT l_orderkey, l_linenumber, l_shipmode AS mode, l_orderkey AS k1, CAST(l_linenumber AS BIGINT) AS k2 FROM (SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS l_shipmode FROM lineitem)")
def rowkey_pk_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("l_returnflag", "l_linestatus").cast("binary")
    key = F.concat(F.unhex(F.lit("07")), text, F.unhex(F.lit("00")), binary.big_endian(F.col("l_orderkey"), 8), binary.big_endian(F.col("l_linenumber"), 2))
    parts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", binary.key_parts(key, [("text", 0), ("number", 8), ("number", 2)], salt=1).alias("p"))
    return parts.select("l_orderkey", "l_linenumber", F.col("p")[0].cast("string").alias("mode"), binary.unsigned(F.col("p")[1], 8).alias("k1"), binary.unsigned(F.col("p")[2], 2).alias("k2"))


@query("SELECT o_orderkey, o_orderkey AS plain, o_custkey - 1000 AS signed_value FROM orders")
def typed_value_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    flipped = F.unhex(F.right(F.concat(F.lit("0" * 16), F.hex((F.col("o_custkey") - 1000).bitwiseXOR(F.lit(-(1 << 63))))), F.lit(16)))
    return table(spark, sf_dir, "orders").select("o_orderkey", binary.unsigned(binary.big_endian(F.col("o_orderkey"), 8), 8).alias("plain"), binary.signed(flipped, 8).alias("signed_value"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey = 0 THEN '80' WHEN n_nationkey % 2 = 0 THEN 'C1' || printf('%02X', n_nationkey + 1) ELSE '3E' || printf('%02X', 101 - n_nationkey) || '66' END AS bytes FROM nation")
def decimal_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey")).otherwise(-F.col("n_nationkey")).cast("decimal(10,0)")
    return table(spark, sf_dir, "nation").select("n_nationkey", F.hex(binary.decimal_bytes(n)).alias("bytes"))


@query("SELECT o_orderkey, o_orderkey * 7 - 10000 AS cents FROM orders")
def decimal_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = ((F.col("o_orderkey") * 7 - 10000).cast("decimal(20,0)") / F.lit(Decimal(100))).cast("decimal(38,2)")
    decoded = binary.decimal_of(binary.decimal_bytes(n), 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", (decoded * 100).cast("long").alias("cents"))


@query("SELECT c_custkey, c_name AS first, c_mktsegment AS second, CAST(2 AS INTEGER) AS n FROM customer")
def text_array_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two texts, each closed by a zero byte, one more, then offsets, their place, the count and a version."""
    zero, a, b = F.unhex(F.lit("00")), F.col("c_name").cast("binary"), F.col("c_mktsegment").cast("binary")
    offset = lambda n: binary.big_endian(n + 0x8001, 2)
    at = F.length(a) + F.length(b) + 4
    packed = F.concat(a, zero, b, zero, zero, zero, offset(F.lit(0)), offset(F.length(a) + 1), binary.big_endian(at, 4), binary.big_endian(F.lit(2), 4), F.unhex(F.lit("01")))
    parts = table(spark, sf_dir, "customer").select("c_custkey", binary.texts_of(packed).alias("p"))
    return parts.select("c_custkey", F.col("p")[0].alias("first"), F.col("p")[1].alias("second"), F.size("p").alias("n"))


@query("SELECT n_nationkey, '04' || printf('%02X', n_nationkey * 2) || '01' || '00' || CASE WHEN n_nationkey % 2 = 0 THEN '00' ELSE '02' || printf('%02X', strlen(n_name) * 2) || hex(n_name) END || '01' AS record FROM nation")
def avro_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(n, F.array(n.cast("long"), F.lit(-1).cast("long")).alias("xs"), F.when(n % 2 != 0, F.col("n_name")).alias("name"), F.lit(True).alias("ok"))
    fields = [("xs", {"type": "array", "items": "long"}, False), ("name", ["null", "string"], False), ("ok", "boolean", False)]
    return rows.select("n_nationkey", F.hex(serialize.avro_record(fields)).alias("record"))


@query("SELECT DISTINCT strftime(ts, '%Y%m%d') AS name, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS part_end FROM events WHERE CAST(ts AS DATE) + 1 < TIMESTAMP '2024-01-20 06:00:00' - INTERVAL 14 DAYS")
def journal_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = (F.date_trunc("day", "ts") + F.make_dt_interval(days=F.lit(1))).cast("timestamp_ntz")
    parts = events(spark, sf_dir).select(F.date_format("ts", "yyyyMMdd").alias("name"), end.alias("part_end")).distinct()
    now = F.to_timestamp_ntz(F.lit("2024-01-20 06:00:00"))
    return journal.expired_partitions(parts, now, 14, now - F.make_dt_interval(days=F.lit(1)))


@query("SELECT n_nationkey, '{\"n_nationkey\":' || n_nationkey || CASE WHEN n_nationkey % 3 <> 0 THEN ',\"n_name\":\"' || n_name || '\"' ELSE '' END || '}' || chr(10) AS line FROM nation")
def json_each_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).alias("n_name"))
    return rows.select("n_nationkey", serialize.json_line(rows, ["n_nationkey", "n_name"]).alias("line"))


@query("SELECT n_nationkey, '{\"n_nationkey\":' || n_nationkey || CASE n_nationkey % 5 WHEN 0 THEN ',\"x\":null' WHEN 1 THEN ',\"x\":null' WHEN 2 THEN ',\"x\":null' WHEN 3 THEN ',\"x\":1.5' ELSE '' END || ',\"b\":[1,-1]}' || chr(10) AS line FROM nation")
def nan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and the infinities are null, a missing number is left out, bytes are signed numbers."""
    k = F.col("n_nationkey") % 5
    x = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, float("-inf")).when(k == 3, 1.5)
    rows = table(spark, sf_dir, "nation").select("n_nationkey", x.alias("x"), F.unhex(F.lit("01FF")).alias("b"))
    return rows.select("n_nationkey", serialize.json_line(rows, ["n_nationkey", "x", "b"]).alias("line"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN '00' ELSE '028280808080808020' END AS record FROM nation")
def avro_wide_longs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long beyond 2**53 beside nulls keeps its last digit."""
    wide = F.when(F.col("n_nationkey") % 2 != 0, F.lit(9007199254740993).cast("long"))
    rows = table(spark, sf_dir, "nation").select("n_nationkey", wide.alias("wide"))
    return rows.select("n_nationkey", F.hex(serialize.avro_record([("wide", "long", True)])).alias("record"))


@query("SELECT n_nationkey, printf('%02X', n_nationkey * 2) || CASE WHEN n_nationkey % 3 <> 0 THEN '02' || printf('%02X', strlen(n_name) * 2) || hex(n_name) ELSE '00' END AS record FROM nation")
def avro_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).alias("n_name"))
    return rows.select("n_nationkey", F.hex(serialize.avro_record([("n_nationkey", "long", False), ("n_name", "string", True)])).alias("record"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_id") % 3 == 0, "planned").when(F.col("event_id") % 3 == 1, "running").otherwise("ok")
    return events(spark, sf_dir).select(F.col("event_id").alias("run_id"), status.alias("status"), F.col("ts").alias("started_at"), F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.make_dt_interval(mins=F.lit(30))).alias("heartbeat_at"))


RUNS = "SELECT event_id AS run_id, CASE event_id % 3 WHEN 0 THEN 'planned' WHEN 1 THEN 'running' ELSE 'ok' END AS status, ts AS started_at, CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 30 MINUTES END AS heartbeat_at FROM events"


@query(f"SELECT run_id, CASE WHEN (status = 'planned' AND new IN ('running', 'skipped')) OR (status = 'running' AND new IN ('ok', 'error')) THEN new ELSE status END AS status FROM (SELECT *, CASE run_id % 4 WHEN 0 THEN 'running' WHEN 1 THEN 'ok' WHEN 2 THEN 'skipped' END AS new FROM ({RUNS}))")
def journal_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = runs(spark, sf_dir)
    k = F.col("run_id") % 4
    news = r.where(k < 3).select("run_id", F.when(k == 0, "running").when(k == 1, "ok").otherwise("skipped").alias("new_status"))
    return journal.transition(r, news).select("run_id", "status")


@query(f"SELECT run_id, CASE WHEN status = 'planned' AND started_at < TIMESTAMP '2024-01-15' - INTERVAL 60 MINUTES THEN 'skipped' WHEN status = 'running' AND (coalesce(heartbeat_at < TIMESTAMP '2024-01-15' - INTERVAL 45 MINUTES, false) OR started_at < TIMESTAMP '2024-01-15' - INTERVAL 12 HOURS) THEN 'error' ELSE status END AS status FROM ({RUNS})")
def sanitize_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.without_stale(runs(spark, sf_dir), F.to_timestamp_ntz(F.lit("2024-01-15"))).select("run_id", "status")


@query("SELECT coalesce(a.process, b.process) AS process, coalesce(b.last, a.last) AS last, coalesce(b.best, a.best) AS best FROM (SELECT user_id AS process, max(event_id) AS last, max(value) AS best FROM events WHERE user_id % 2 = 0 GROUP BY 1) a FULL JOIN (SELECT user_id AS process, min(event_id) AS last, max(CASE WHEN user_id % 5 <> 0 THEN value END) AS best FROM events WHERE user_id % 3 = 0 GROUP BY 1) b ON a.process = b.process")
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumnRenamed("user_id", "process")
    old = e.where("process % 2 = 0").groupBy("process").agg(F.max("event_id").alias("last"), F.max("value").alias("best"))
    new = e.where("process % 3 = 0").groupBy("process").agg(F.min("event_id").alias("last"), F.max(F.when(F.col("process") % 5 != 0, F.col("value"))).alias("best"))
    return journal.upsert(old, new)


@query("SELECT p AS topic, CASE WHEN a IS NULL THEN 'create' WHEN w > a THEN 'increase' ELSE 'keep' END AS action FROM (SELECT 't' || p_partkey AS p, p_size AS w, CASE WHEN p_partkey % 3 <> 0 THEN 12 END AS a FROM part)")
def topic_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("topic"), F.col("p_size").alias("partitions"), "p_partkey")
    return publish.topic_plan(p.drop("p_partkey"), p.where("p_partkey % 3 <> 0").select("topic", F.lit(12).alias("partitions")))


@query(f"SELECT part, user_id, event_type, arg_max(value, row(ts, event_id)) AS value FROM (SELECT *, {PART} AS part FROM events) GROUP BY 1, 2, 3")
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a stream into RAW, each touched day published to CLEAN; the result is CLEAN."""
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = events(spark, sf_dir)
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 8).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parque[t]")
    rows = stream.select("user_id", "event_type", "value", "ts", "event_id")
    ingest(rows, f"{at}/raw", f"{at}/clean", f"{at}/state", ["user_id", "event_type"], ["ts", "event_id"], "ts").awaitTermination()
    return spark.read.parquet(f"{at}/clean").select("part", "user_id", "event_type", "value")


def _cell_stream(spark: SparkSession, sf_dir: str) -> tuple[SnapshotTable, CommitLog]:
    """The cells of events, whole entries in a file, as a stream into RAW and CLEAN; the clean table and the counters."""
    at = f"{shared_folder(spark)}/cells-{uuid.uuid4().hex}"
    found = event_cells(spark, sf_dir)
    found.repartition(8, "entry_id").write.parquet(f"{at}/cells")
    stream = spark.readStream.schema(found.schema).option("maxFilesPerTrigger", 3).parquet(f"{at}/cells")
    clean, counters = SnapshotTable(spark, f"{at}/clean"), CommitLog(spark, f"{at}/counters")
    text = lambda rows: rows.withColumn("rowkey", F.col("rowkey").cast("string"))
    run = ingest_cells(stream, ["value", "props"], f"{at}/raw", clean, f"{at}/state", counters, ["rowkey"], ["_event_ts", "entry_id"], ["m"], shape=text)
    run.awaitTermination()
    return clean, counters


@query(f"""SELECT CAST(strftime(make_timestamp(_event_ts * 1000), '%Y%m%d') AS INTEGER) AS part, rowkey, arg_max(value, row(_event_ts, entry_id)) AS value, arg_max(props, row(_event_ts, entry_id)) AS props
FROM ({ROWS} FROM ({CELLS}) GROUP BY 1, 2 HAVING bool_or(family = 'm')) GROUP BY 1, 2""")
def stream_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as a stream, put together to rows, filtered by family, published by day."""
    clean, _ = _cell_stream(spark, sf_dir)
    return clean.read().select("part", "rowkey", "value", "props")


@query(f"""SELECT CAST(sum(_cells_total) AS BIGINT) AS cells, count(*) AS rows, count(*) FILTER (NOT sent) AS filtered_rows, count(*) FILTER (_delete) AS deletes
FROM ({ROWS}, bool_or(family = 'm') AS sent FROM ({CELLS}) GROUP BY 1, 2)""")
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same stream counted while it wrote."""
    _, counters = _cell_stream(spark, sf_dir)
    return counted(spark, counters).agg(*(F.sum(c).alias(c) for c in ["cells", "rows", "filtered_rows", "deletes"]))
