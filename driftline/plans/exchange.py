"""Queries of what goes out and comes back: typed bytes, payloads, JSON lines, Avro."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from driftline.functions import binary, time
from driftline.operators import cells, decode, payload, serialize
from driftline.plans.queries import CELLS, event_cells, events, query, table
from driftline.sources import messages


def _sortable_long(n):
    """A long in 8 bytes with its sign bit flipped."""
    return F.unhex(F.right(F.concat(F.lit("0" * 16), F.hex(n.bitwiseXOR(F.lit(-(1 << 63))))), F.lit(16)))


@query("SELECT o_orderkey, o_orderstatus AS status, o_custkey AS customer, CAST(o_custkey % 100 - 50 AS SMALLINT) AS small, o_orderpriority AS priority, epoch_ms(o_orderdate) AS ordered, o_orderkey % 2 = 1 AS odd, CAST(o_orderkey * 7 - 10000 AS BIGINT) AS cents, o_orderpriority AS other FROM orders")
def typed_row_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of orders decoded by the names of their types; a type that is not known is text."""
    o = table(spark, sf_dir, "orders")
    cents = ((F.col("o_orderkey") * 7 - 10000).cast("decimal(20,0)") / F.lit(Decimal(100))).cast("decimal(38,2)")
    raw = o.select(
        "o_orderkey",
        F.concat(F.col("o_orderstatus"), F.lit("   ")).cast("binary").alias("status"),
        binary.big_endian(F.col("o_custkey"), 4).alias("customer"),
        binary.big_endian(F.col("o_custkey") % 100 - 50 + 128, 1).alias("small"),
        F.col("o_orderpriority").cast("binary").alias("priority"),
        F.concat(_sortable_long(F.floor(time.epoch_us(F.col("o_orderdate")) / 1000)), F.unhex(F.lit("00000000"))).alias("ordered"),
        binary.big_endian(F.col("o_orderkey") % 2, 1).alias("odd"),
        binary.decimal_bytes(cents).alias("cents"),
        F.col("o_orderpriority").cast("binary").alias("other"),
    )
    kinds = {"status": "char(4)", "customer": "UNSIGNED_INT", "small": "tinyint", "priority": "VARCHAR", "ordered": "TIMESTAMP", "odd": "bool", "cents": "DECIMAL(38, 2)", "other": "no such type"}
    return decode.typed(raw, kinds).withColumn("cents", (F.col("cents") * 100).cast("long"))


@query("SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS mode, l_orderkey AS k1, CAST(l_linenumber AS INTEGER) AS k2 FROM lineitem")
def rowkey_typed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A salted key of a text, a long and a whole number of four bytes, by the names of their types."""
    text = F.concat("l_returnflag", "l_linestatus").cast("binary")
    key = F.concat(F.unhex(F.lit("07")), text, F.unhex(F.lit("00")), binary.big_endian(F.col("l_orderkey"), 8), binary.big_endian(F.col("l_linenumber"), 4))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key.alias("key"))
    out = decode.keyed(rows, "key", {"mode": "VARCHAR", "k1": "UNSIGNED_LONG", "k2": "UNSIGNED_INT"}, salt=1)
    return out.select("l_orderkey", "l_linenumber", "mode", "k1", F.col("k2").cast("int").alias("k2"))


@query(f"""SELECT 'ns:ev' AS _table, 'ns' AS _namespace, 'ev' AS _qualifier, 'm' AS _cf, count(*) AS _cells_total, entry_id AS k,
arg_max(value, cell_index) FILTER (qualifier = 'value' AND NOT is_delete) AS value, arg_max(value, cell_index) FILTER (qualifier = 'props' AND NOT is_delete) AS props,
count(*) FILTER (family = 'm') AS _cells_cf, max(cell_ts) AS _event_ts, CASE WHEN bool_or(is_delete) THEN 1 END AS _delete, lower(hex(substr(rowkey, 2))) AS _rowkey, max(cell_index // 2) AS _wal_seq
FROM ({CELLS}) WHERE length(rowkey) > 1 GROUP BY entry_id, rowkey HAVING bool_or(family = 'm')""")
def payload_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = [F.count_if(F.col("family") == "m").alias("_cells_cf"), F.max(F.floor(F.col("cell_index") / 2)).alias("_wal_seq")]
    rows = cells.rows_of(event_cells(spark, sf_dir), ["value", "props"], ["m"], more=more).withColumn("k", F.col("entry_id"))
    return payload.payload(rows, "ns", "ev", ["k"], ["value", "props"], families="m", rowkey="hex", salt=1)


@query(f"""SELECT entry_id, rowkey, coalesce('{{' || string_agg(CAST(to_json(qualifier) AS VARCHAR) || ':' || CAST(to_json(value) AS VARCHAR), ',' ORDER BY first) || '}}', '{{}}') AS line,
CAST(sum(n) AS BIGINT) AS _cells_total, max(ts) AS _event_ts, bool_or(gone) AS _delete
FROM (SELECT entry_id, rowkey, qualifier, min(cell_index) FILTER (value IS NOT NULL AND NOT is_delete) AS first, arg_max(value, cell_index) FILTER (value IS NOT NULL AND NOT is_delete) AS value,
count(*) AS n, max(cell_ts) AS ts, bool_or(is_delete) AS gone FROM ({CELLS}) GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def cells_to_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose columns nobody listed, as JSON with the columns in the order in which they first got a value."""
    rows = cells.row_maps(event_cells(spark, sf_dir)).withColumn("rowkey", F.col("rowkey").cast("string"))
    return rows.withColumn("line", serialize.json_text(F.col("values"), rows.schema["values"].dataType)).drop("values")


@query("SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0")
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines written from events and read back; lines cut short and lines without a required field are left out."""
    e = events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 17 != 0, F.col("event_type")).alias("event_type"), F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"), F.floor(time.epoch_us(F.col("ts")) / 1000).alias("ts"))
    line = serialize.json_line(e, e.columns)
    sent = e.select(F.when(F.col("event_id") % 13 == 0, F.left(line, F.lit(9))).otherwise(line).alias("line"))
    schema = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("event_type", T.StringType(), False), T.StructField("user_id", T.LongType()), T.StructField("ts", T.LongType(), False)])
    return messages.json_rows(sent, "line", schema, ["ts"])


@query("SELECT event_id, event_type, value, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, CASE WHEN event_id % 7 <> 0 THEN event_id * 4503599627 END AS wide FROM events")
def avro_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Avro records in frames, written from events and read back."""
    fields = [("event_id", "long", False), ("event_type", "string", False), ("value", "double", False), ("ts", "long", False), ("wide", "long", True)]
    e = events(spark, sf_dir).withColumn("ts", F.floor(time.epoch_us(F.col("ts")) / 1000)).withColumn("wide", F.when(F.col("event_id") % 7 != 0, F.col("event_id") * F.lit(4503599627)))
    sent = e.select(binary.confluent_frame(F.lit(7), serialize.avro_record(fields)).alias("frame"))
    schema = {"type": "record", "name": "event", "fields": [{"name": n, "type": ["null", t] if nullable else t} for n, t, nullable in fields]}
    return messages.avro_rows(sent, "frame", schema, ["ts"])


@query("SELECT n_nationkey, '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":' || CASE WHEN n_nationkey % 3 <> 0 THEN '\"' || n_name || '\"' ELSE 'null' END || '}' || chr(10) AS line FROM nation")
def json_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).alias("n_name"))
    return rows.select("n_nationkey", serialize.json_line(rows, ["n_nationkey", "n_name"], nulls=True).alias("line"))


@query("SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 2 = 0, c_custkey) AS place FROM customer")
def rowkey_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row keys in the order of their unsigned bytes."""
    number = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") - (1 << 62)).otherwise(F.col("c_custkey"))  # the negative ones come last, as bytes
    c = table(spark, sf_dir, "customer").withColumn("key", binary.big_endian(number, 8))
    return c.select("c_nationkey", "c_custkey", F.expr("row_number() OVER (PARTITION BY c_nationkey ORDER BY key)").cast("long").alias("place"))


@query("""SELECT event_id, '{"event_id":' || event_id || ',"xs":[' || CASE event_id % 3 WHEN 0 THEN 'null,1.5' WHEN 1 THEN '2.5,null' ELSE 'null,null,0.5' END || '],"bs":[[1,-1],' || CASE WHEN event_id % 2 = 0 THEN '[]' ELSE 'null' END
|| '],"m":{"a":' || CASE WHEN event_id % 2 = 0 THEN 'null' ELSE '3.5' END || ',"b":null},"s":{"t":"' || event_type || '"' || CASE WHEN event_id % 4 = 0 THEN ',"n":' || user_id ELSE '' END || '}}' || chr(10) AS line FROM events""")
def json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN, infinities and bytes inside arrays, maps and structs are written as they are outside."""
    k, nan, inf = F.col("event_id"), F.lit(float("nan")), F.lit(float("-inf"))
    xs = F.when(k % 3 == 0, F.array(nan, F.lit(1.5))).when(k % 3 == 1, F.array(F.lit(2.5), inf)).otherwise(F.array(nan, F.lit(None).cast("double"), F.lit(0.5)))
    bs = F.array(F.unhex(F.lit("01FF")), F.when(k % 2 == 0, F.unhex(F.lit(""))))
    m = F.create_map(F.lit("a"), F.when(k % 2 == 0, inf).otherwise(F.lit(3.5)), F.lit("b"), F.lit(None).cast("double"))
    rows = events(spark, sf_dir).select("event_id", xs.alias("xs"), bs.alias("bs"), m.alias("m"), F.struct(F.col("event_type").alias("t"), F.when(k % 4 == 0, F.col("user_id")).alias("n")).alias("s"))
    return rows.select("event_id", serialize.json_line(rows, ["event_id", "xs", "bs", "m", "s"]).alias("line"))


@query("SELECT event_id, event_type FROM events WHERE event_id % 5 <> 0 UNION ALL SELECT -event_id, 'again' FROM events WHERE event_id % 3 = 0")
def json_many_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of several lines; lines with something behind the object are left out, the others of the message stay."""
    e = events(spark, sf_dir).select("event_id", "event_type")
    first = serialize.json_line(e, ["event_id", "event_type"])
    bad = F.concat(F.rtrim(F.translate(first, "\n", "")), F.when(F.col("event_id") % 2 == 0, " trash\n").otherwise(',{"event_id":1,"event_type":"x"}\n'))
    again = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('\n{"event_id":-'), F.col("event_id").cast("string"), F.lit(',"event_type":"again"}'))).otherwise("")
    sent = e.select(F.concat(F.when(F.col("event_id") % 5 == 0, bad).otherwise(first), again).alias("message"))
    schema = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("event_type", T.StringType(), False)])
    return messages.json_rows(sent, "message", schema)


def _record(*fields: tuple) -> dict:
    return {"type": "record", "name": "event", "fields": [{"name": n, "type": t} | dict(more) for n, t, *more in fields]}


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS customer, CASE event_id % 4 WHEN 0 THEN 'none' ELSE event_type END AS kind, event_id % 4 = 2 AS late FROM events WHERE event_id % 4 <> 3")
def avro_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of three versions of a schema in one column, told by the id in their frames; a fourth id is unknown."""
    e = events(spark, sf_dir).select("event_id", "event_type", F.col("user_id").cast("int").alias("user_id"), F.lit(True).alias("late"), F.lit("x").alias("gone"))
    layouts = {
        11: [("gone", "string", False), ("event_id", "int", False)],
        12: [("event_id", "long", False), ("user_id", "int", True), ("event_type", "string", False)],
        13: [("late", "boolean", False), ("event_type", "string", True), ("user_id", "long", False), ("event_id", "long", False), ("gone", "string", True)],
        14: [("event_id", "long", False)],
    }
    k = F.col("event_id") % 4
    frames = [e.where(k == i).select(binary.confluent_frame(F.lit(n), serialize.avro_record(fields)).alias("frame")) for i, (n, fields) in enumerate(layouts.items())]
    sent = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])
    writers = {n: _record(*((f, ["null", t] if nullable else t) for f, t, nullable in layouts[n])) for n in (11, 12, 13)}
    reader = _record(("event_id", "long"), ("customer", ["null", "double"], ("aliases", ["user_id"]), ("default", None)), ("kind", "string", ("aliases", ["event_type"]), ("default", "none")), ("late", "boolean", ("default", False)))
    reader["fields"][2]["type"] = ["string", "null"]
    return messages.avro_rows(sent, "frame", reader, skip=True, writers=writers)


@query("SELECT event_id, user_id FROM events WHERE event_id % 6 = 0")
def avro_bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number out of range, a branch that does not exist, something behind the record, one cut short, nulls without end: left out."""
    k = F.col("event_id") % 6
    good = serialize.avro_record([("event_id", "long", False), ("user_id", "long", True), ("small", "long", False)])
    e = events(spark, sf_dir).select("event_id", "user_id", F.when(k == 1, F.lit(1 << 40)).otherwise(F.lit(5).cast("long")).alias("small"))
    none, endless, branch = (F.unhex(F.lit(h)) for h in ("00", "FEFFFFFFFFFFFFFF7F", "01"))
    body = F.when(k == 2, F.concat(good, none, none)).when(k == 3, F.concat(good, endless)).when(k == 4, F.concat(serialize.avro_record([("event_id", "long", False)]), branch)).when(k == 5, F.substr(good, F.lit(1), F.length(good) - 1)).otherwise(F.concat(good, none))
    schema = _record(("event_id", "long"), ("user_id", ["null", "long"]), ("small", "int"), ("nothing", {"type": "array", "items": "null"}))
    rows = messages.avro_rows(e.select(binary.confluent_frame(F.lit(1), body).alias("frame")), "frame", schema, skip=True)
    return rows.select("event_id", "user_id")
