"""Functions that no query reaches, at their edges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from driftline.functions import binary, naming, time
from driftline.operators import cells, decode, payload
from driftline.sources import messages, schemas
from driftline.streaming.ingest import ingest


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def raw(text):
    return F.unhex(F.lit(text.replace(" ", "")))


def test_names(spark):
    assert naming.families(" d, m,,d ") == ["d", "m"]
    assert naming.salt_map("A=2, ns:b:1, c, d=12") == {"A": 2, "NS:B": 1, "C": 1, "D": 8}
    assert [naming.type_name(x) for x in ("varchar(9)", "Array<char>", "x[]", "unsigned_int", "", "  ")] == ["VARCHAR", "CHAR ARRAY", "X ARRAY", "UNSIGNED INT", "VARCHAR", "VARCHAR"]
    assert [naming.payload_format(x) for x in ("JSON", "avro-bin", "AvroJson", "what", None)] == ["json_each_row", "avro_binary", "avro_json", "json_each_row", "json_each_row"]
    assert [naming.avro_mode(x) for x in (" Confluent", "x", None)] == ["confluent", "generic", "generic"]
    assert [one(spark, naming.valid_topic(F.lit(x))) for x in ("a.b", "..", "a b", "x" * 250, None)] == [True, False, False, False, False]
    for strategy, want in (("table", "ns_Tab-value"), ("upper", "NS_TAB-value"), ("lower", "ns_tab-value"), ("qualifier", "Tab-value")):
        assert one(spark, naming.subject(F.lit("ns"), F.lit("Tab"), strategy)) == want


def test_times(spark):
    assert [one(spark, time.normal_offset(F.lit(x))) for x in ("1 +05", "1 +0530", "1 +05:30")] == ["1 +05:00", "1 +05:30", "1 +05:30"]
    day = dt.datetime(2024, 1, 2, 3, 4, 5)
    for text, want in (("2024-01-02T03:04:05Z", day), ("2024-01-02 03:04:05.", day), ("2024-01-02 03:04:05.1234569", day.replace(microsecond=123456)), ("2024-01-02 03:04:05+01:00", None), ("2024-01-02", None), (" ", None)):
        assert one(spark, time.utc_of_text(F.lit(text))) == want
    assert one(spark, time.utc_of_number(F.lit(1.5))) == dt.datetime(1970, 1, 1, 0, 0, 1, 500000)
    assert [r.start for r in time.ceil_slices(spark, "2024-01-01", "2024-01-01", 5).collect()] == []


@pytest.mark.parametrize(("text", "value"), [("BFF0000000000001", 1.0), ("8000000000000001", 0.0), ("4010000000000000", -1.0)])
def test_double_known(spark, text, value):
    """Fixed values of the format: bits with the sign flipped (all of a negative number), plus one."""
    assert one(spark, binary.double_of(raw(text))) == value


def test_numbers(spark):
    assert one(spark, binary.float_of(raw("BFC00001"))) == 1.5
    assert one(spark, binary.double_of(F.lit(None).cast("binary"))) is None
    assert one(spark, binary.millis(raw("8000000000000001 00000000"), 12)) == 1
    for c in (binary.float_of(raw("00")), binary.unsigned(raw("0000"), 1), binary.millis(raw("80"), 8)):
        with pytest.raises(Exception, match="expected"):
            one(spark, c)


def test_decoded(spark):
    known = {"CHAR": ("6120", "a"), "BOOLEAN": ("01", True), "SMALLINT": ("7FFF", -1), "UNSIGNED_SMALLINT": ("FFFF", 65535), "VARBINARY": ("00FF", b"\0\xff"), "DATE": ("8000000000000005", 5), "mystery": ("6162", "ab")}
    for kind, (text, want) in known.items():
        assert one(spark, decode.decoded(raw(text), kind)) == want
        assert one(spark, decode.decoded(F.lit(None).cast("binary"), kind)) is None


def test_row_keys(spark):
    """Escaped bytes, keys that are too short, and a last text that keeps its zero bytes."""
    text = [("t", 0), ("n", 2)]
    assert one(spark, binary.key_parts(raw("61FF00 62FFFF63 00 0102"), text)) == [b"a\0b\xffc", b"\1\2"]
    assert one(spark, binary.key_parts(raw("61 00 01"), text)) == [b"a", None]
    assert one(spark, binary.key_parts(raw("61"), text)) == [None, None]
    assert one(spark, binary.key_parts(raw("0102 61 00 62"), [("n", 2), ("t", 0)])) == [b"\1\2", b"a\0b"]


def _cut_by_hand(key, widths, salt):
    """The columns of a key, byte by byte."""
    out, at = [], salt
    for k, width in enumerate(widths):
        end = at + width if width else at
        if not width and k == len(widths) - 1:
            end = max(at, len(key))
        while not width and k < len(widths) - 1 and end < len(key) and (key[end] or (end > at and key[end - 1] == 255)):
            end += 1
        if end > len(key) or at > len(key) or (not width and k < len(widths) - 1 and end == len(key)):
            break
        part, plain, k2 = key[at:end], bytearray(), 0
        while not width and k2 < len(part):
            escaped = part[k2] == 255 and part[k2 + 1 : k2 + 2] in (b"\0", b"\xff")
            plain.append(part[k2 + 1] if escaped else part[k2])
            k2 += 2 if escaped else 1
        out.append(part if width else bytes(plain))
        at = end if width else end + 1
    return out + [None] * (len(widths) - len(out))


@pytest.mark.parametrize("widths, salt", [((0, 2), 0), ((1, 0, 0, 2, 0), 1), ((2, 0), 2), ((0,), 1), ((0, 0, 0), 0), ((3, 1), 1)])
def test_random_row_keys(spark, widths, salt):
    """20,000 keys of few different bytes, so that zero bytes, escapes and ends meet in all ways; no Python in the plan."""
    rng = random.Random(repr((widths, salt)))
    keys = [bytes(rng.choices(b"\0\xff\x0aa\x80", k=rng.randrange(12))) for _ in range(20_000)]
    rows = spark.createDataFrame([(k, key) for k, key in enumerate(keys)], "k int, key binary")
    got = rows.select("k", binary.key_parts(F.col("key"), [("", w) for w in widths], salt).alias("p"))
    assert "Python" not in got._jdf.queryExecution().toString().replace("PythonRDD", "")
    for r in got.collect():
        assert [p if p is None else bytes(p) for p in r.p] == _cut_by_hand(keys[r.k], widths, salt), keys[r.k]


def test_very_long_row_key(spark):
    key = F.concat(F.repeat(F.lit("ab"), 500_000).cast("binary"), raw("FF00FFFF62 00 0102"))
    got = one(spark, binary.key_parts(key, [("", 0), ("", 2)]))
    assert got == [b"ab" * 500_000 + b"\0\xffb", b"\1\2"]
    assert one(spark, binary.key_parts(F.lit(None).cast("binary"), [("", 0), ("", 2), ("", 0)])) == [None, None, None]


def test_rows_of_any_columns(spark):
    """First-seen order, the last value, deleted and null cells, a row without values, an empty table; one exchange."""
    layout = "entry_id long, rowkey binary, cell_index long, cell_ts long, family string, qualifier string, value string, is_delete boolean, values string"
    cell = lambda row, i, q, v, gone=False: (1, row, i, 10 + i, "d", q, v, gone, "clash")
    rows = [cell(b"a", 0, "z", None), cell(b"a", 1, "b", "1"), cell(b"a", 2, "z", "2"), cell(b"a", 3, "b", "3"), cell(b"a", 4, "b", "4", True), cell(b"b", 5, "x", None), cell(None, 6, "y", "")]
    got = cells.row_maps(spark.createDataFrame(rows, layout))
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    found = {r.rowkey and bytes(r.rowkey): (list(r["values"].items()), r._cells_total, r._event_ts, r._delete) for r in got.collect()}
    assert found == {b"a": ([("b", "3"), ("z", "2")], 5, 14, True), b"b": ([], 1, 15, False), None: ([("y", "")], 1, 16, False)}
    assert cells.row_maps(spark.createDataFrame([], layout)).count() == 0


def test_schemas(tmp_path):
    (tmp_path / "t.avsc").write_text('{"type":"record","name":"t","fields":[{"name":"a","type":["null","long"],"pk":1},{"name":"b","type":{"type":"array","items":"string"}},{"name":"c","type":{"type":"map","values":"int"}},{"name":"d","type":{"type":"enum","symbols":["x"]}}]}')
    got = schemas.avro_schema(str(tmp_path), "T")
    assert got.simpleString() == "struct<a:bigint,b:array<string>,c:map<string,int>,d:string>"
    assert got["a"].nullable and got["a"].metadata == {"pk": 1}
    (tmp_path / "s.json").write_text('{"ns:Tab": {"columns": {"A": "CHAR"}, "pk": ["A"]}}')
    got = schemas.json_schemas(str(tmp_path / "s.json"))
    assert got["TAB"] == got["ns:tab"] == {"columns": {"a": "CHAR"}, "pk": ["a"]}


def test_json_rows(spark):
    lines = ['{"a":1,"b":[1],"more":0}', '{"a":2}', '{"a":"x"}', "nonsense", '{"b":[2]}', "", None]
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.ArrayType(T.LongType()))])
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert sorted(map(tuple, messages.json_rows(df, "line", schema).collect())) == [(1, [1]), (2, [])]


def test_avro_rows(spark):
    schema = {"fields": [{"name": "a", "type": ["null", "long"]}, {"name": "m", "type": {"type": "map", "values": "string"}}, {"name": "e", "type": {"type": "enum", "symbols": ["x", "y"]}}]}
    good, empty = "00 00000007 02 02 02 02 6B 02 76 00 02", "00 00000007 00 00 00"
    df = spark.createDataFrame([(bytes.fromhex(x.replace(" ", "")),) for x in (good, empty, "01 00000007 00 00 00", "00 00", "00 00000007 02")] + [(None,)], "f binary")
    got = messages.avro_rows(df, "f", schema, skip=True).collect()
    assert [tuple(r) for r in got] == [(1, {"k": "v"}, "y"), (None, {}, "x")]
    with pytest.raises(Exception, match="not a frame|too early"):
        messages.avro_rows(df, "f", schema).collect()
    assert [r[0] for r in df.select(messages.frame_id(F.col("f"))).collect()] == [7, 7, None, None, 7, None]


def test_strict_families_and_payload(spark):
    c = spark.createDataFrame([(1, b"\1k", 0, 5, "d", "a", "1", False), (1, b"\1k", 1, 7, "m", "b", "2", False), (2, b"\1q", 0, 5, "d", "a", "3", False)], "entry_id int, rowkey binary, cell_index int, cell_ts long, family string, qualifier string, value string, is_delete boolean")
    rows = cells.rows_of(c, ["a", "b"], ["m"], strict=True)
    assert [(r.a, r.b, r._cells_total) for r in rows.collect()] == [(None, "2", 1)]
    sent = payload.payload(rows, "default", "t", [], ["a", "b"], rowkey="base64", salt=1)
    assert sent.columns == ["a", "b", "_event_ts", "_delete", "_rowkey"]
    assert tuple(sent.first()) == (None, "2", 7, None, "aw==")


def test_replay(spark, tmp_path):
    """A stream that is read again from its start into the same folders leaves CLEAN as it is and doubles nothing in RAW."""
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 1), 1.0), (1, dt.datetime(2024, 1, 1, 2), 2.0), (2, dt.datetime(2024, 1, 2), 3.0)], "k int, ts timestamp_ntz, v double")
    rows.write.parquet(f"{tmp_path}/in")
    results = []
    for k in range(2):
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
        ingest(stream, f"{tmp_path}/raw", f"{tmp_path}/clean", f"{tmp_path}/state{k}", ["k"], ["ts"], "ts").awaitTermination()
        results.append((spark.read.parquet(f"{tmp_path}/raw").count(), sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/clean").collect())))
    assert results == [(3, [(1, 2.0), (2, 3.0)])] * 2
