"""Typed bytes and Avro against known bytes and round trips."""

import struct
from decimal import Decimal

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from driftline.functions import binary
from driftline.operators.serialize import _avro


@pytest.mark.parametrize(("raw", "value"), [("80", "0"), ("c102", "1"), ("c103 33", "2.5"), ("c00b", "0.1"), ("c202", "100"), ("3e6466", "-1"), ("3f6466", "-0.01"), ("3e63 33 66", "-2.5")])
def test_decimal_known(raw, value):
    assert binary._decimal(bytes.fromhex(raw)) == Decimal(value)


@pytest.mark.parametrize("raw", ["01", "", "c1", "c1ff"])
def test_decimal_broken(raw):
    with pytest.raises(ValueError):
        binary._decimal(bytes.fromhex(raw))


def test_decimal_round_trip(spark):
    values = [Decimal(x) for x in ("0", "7", "-7", "10", "123456.789", "-0.000001", "99999999999999.99", "-1000")] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(38,6)")
    rows = df.select("v", binary.decimal_of(binary.decimal_bytes(F.col("v")), 6).alias("w"), F.hex(binary.decimal_bytes(F.col("v"))).alias("b")).collect()
    assert all(r.v == r.w for r in rows)
    # The bytes sort as the numbers do.
    known = sorted((r.v, r.b) for r in rows if r.v is not None)
    assert [b for _, b in known] == sorted(b for _, b in known)


def packed(items, wide=False):
    body, starts, nulls = b"", [], 0
    for x in items:
        if not x:
            starts.append(len(body))
            nulls += 1
            continue
        if nulls:
            body += bytes([0, 256 - nulls])
            nulls = 0
        starts.append(len(body))
        body += x.encode() + b"\0"
    body += b"\0\0"
    offsets = b"".join(struct.pack(">i", s) if wide else struct.pack(">h", s - 0x7FFF) for s in starts)
    return body + offsets + struct.pack(">iib", len(body), -len(items) if wide else len(items), 1)


@given(st.lists(st.text(st.characters(min_codepoint=1, codec="utf-8"), max_size=9), max_size=9), st.booleans())
def test_text_array(items, wide):
    assert binary._texts(packed(items, wide)) == [x or None for x in items]


def test_text_array_broken(spark):
    assert spark.sql("SELECT CAST(NULL AS BINARY) AS b").select(binary.texts_of(F.col("b"))).first()[0] is None
    for raw in (b"abc", struct.pack(">iib", 90, 2, 1)):
        with pytest.raises(ValueError):
            binary._texts(raw)


def test_avro_known():
    assert _avro({"type": "map", "values": "int"}, {"a": 1}) == b"\x02\x02a\x02\x00"
    assert _avro({"type": "array", "items": "string"}, []) == b"\x00"
    assert _avro({"type": "enum", "symbols": ["x", "y"]}, "y") == b"\x02"
    assert _avro({"type": "fixed", "size": 2}, b"ab") == b"ab"
    assert _avro(["null", "string", "long"], 3) == b"\x04\x06"
    assert _avro(["null", "boolean", "long"], True) == b"\x02\x01"
    assert _avro({"type": "record", "fields": [{"name": "a", "type": "long", "default": 2}, {"name": "b", "type": ["null", "bytes"]}]}, {"b": b"z"}) == b"\x04\x02\x02z"
    assert _avro("float", 1.5) == struct.pack("<f", 1.5)
    for kind, value in (("int", 1 << 31), ({"type": "fixed", "size": 2}, b"a"), (["null", "long"], "x"), ("long", None)):
        with pytest.raises(ValueError):
            _avro(kind, value)
