"""Rows as JSON lines or Avro."""

from __future__ import annotations

import json
import struct
from numbers import Integral

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.column import Column


def _inside(value: Column) -> Column:
    """A value as Spark writes it in JSON."""
    text = F.to_json(F.struct(value.alias("v")))
    return F.substr(text, F.lit(6), F.length(text) - 6)


def json_text(value: Column, kind: T.DataType) -> Column:
    """A value in JSON at any depth: NaN and the infinities as null, bytes as arrays of signed numbers; null for null.

    Fields of a struct that are null are left out; items and values of maps are written as null.
    """
    or_null = lambda v, k: F.coalesce(json_text(v, k), F.lit("null"))
    listed = lambda parts, ends: F.when(value.isNotNull(), F.concat(F.lit(ends[0]), F.array_join(parts, ","), F.lit(ends[1])))
    match kind:
        case T.DoubleType() | T.FloatType():
            return F.when(F.isnan(value) | (F.abs(value) == float("inf")), "null").when(value.isNotNull(), _inside(value))
        case T.BinaryType():
            places = F.when(F.length(value) > 0, F.sequence(F.lit(1), F.length(value))).otherwise(F.array().cast("array<int>"))
            byte = lambda i: F.conv(F.hex(F.substr(value, i, F.lit(1))), 16, 10).cast("int")
            return listed(F.transform(places, lambda i: (byte(i) - F.when(byte(i) > 127, 256).otherwise(0)).cast("string")), "[]")
        case T.ArrayType():
            return listed(F.transform(value, lambda v: or_null(v, kind.elementType)), "[]")
        case T.MapType():
            pair = lambda e: F.concat(_inside(e["key"].cast("string")), F.lit(":"), or_null(e["value"], kind.valueType))
            return listed(F.transform(F.map_entries(value), pair), "{}")
        case T.StructType():
            fields = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), json_text(value[f.name], f.dataType)) for f in kind.fields]
            return F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))
    return F.when(value.isNotNull(), _inside(value))


def json_line(df: DataFrame, columns: list[str], nulls: bool = False) -> Column:
    """A JSON object and a line feed: columns that are null left out (or written, with nulls), values as json_text() writes them."""

    def field(c: str) -> Column:
        name = json.dumps(c, ensure_ascii=False) + ":"
        text = json_text(F.col(c), df.schema[c].dataType)
        return F.concat(F.lit(name), F.coalesce(text, F.lit("null")) if nulls else text)

    return F.concat(F.lit("{"), F.concat_ws(",", *map(field, columns)), F.lit("}\n"))


def _long(n: int) -> bytes:
    n, out = (n << 1) ^ (n >> 63), bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


_AVRO = {
    "null": lambda v: b"",
    "string": lambda v: _long(len(b := str(v).encode())) + b,
    "bytes": lambda v: _long(len(v)) + bytes(v),
    "int": lambda v: _long(_within(int(v), 32)),
    "long": lambda v: _long(_within(int(v), 64)),
    "float": lambda v: struct.pack("<f", float(v)),
    "double": lambda v: struct.pack("<d", float(v)),
    "boolean": lambda v: b"\1" if v else b"\0",
}
#: What a value must be to take a branch of a union.
_TAKES = {"string": str, "bytes": (bytes, bytearray), "int": Integral, "long": Integral, "float": float, "double": float, "boolean": (bool, np.bool_), "enum": str, "fixed": (bytes, bytearray), "array": (list, np.ndarray), "map": dict, "record": dict}


def _within(n: int, bits: int) -> int:
    if not -(1 << bits - 1) <= n < 1 << bits - 1:
        raise ValueError(f"{n} does not fit into {bits} bits")
    return n


def _missing(v) -> bool:
    return v is None or v is pd.NaT or v is pd.NA


def _blocks(items: list[bytes]) -> bytes:
    """Items of an array or map: one block with its count, if there are any, and an empty one."""
    return (_long(len(items)) + b"".join(items) if items else b"") + b"\0"


def _takes(kind, v) -> bool:
    name = kind["type"] if isinstance(kind, dict) else kind
    if _missing(v) or name == "null":
        return _missing(v) and name == "null"
    if isinstance(v, list) and v and all(isinstance(x, tuple) for x in v):  # a map, as Arrow gives it
        v = dict(v)
    truth = isinstance(v, (bool, np.bool_))
    return isinstance(v, _TAKES[name]) and truth == (name == "boolean")


def _avro(kind, v) -> bytes:
    """The binary form of a value by its Avro type as in a schema: a name, an object, or a list for a union (first branch that takes it)."""
    if isinstance(kind, list):
        branch = next((k for k, x in enumerate(kind) if _takes(x, v)), None)
        if branch is None:
            raise ValueError(f"no branch of {kind} takes {v!r}")
        return _long(branch) + _avro(kind[branch], v)
    if isinstance(kind, str):
        if _missing(v) and kind != "null":
            raise ValueError(f"a value of type {kind} is required")
        return _AVRO[kind](v)
    if _missing(v):
        raise ValueError(f"a value of type {kind['type']} is required")
    match kind["type"]:
        case "array":
            return _blocks([_avro(kind["items"], x) for x in v])
        case "map":
            return _blocks([_AVRO["string"](k) + _avro(kind["values"], x) for k, x in dict(v).items()])
        case "record":
            return b"".join(_avro(f["type"], v.get(f["name"], f.get("default")) if _missing(v.get(f["name"])) else v[f["name"]]) for f in kind["fields"])
        case "enum":
            return _long(kind["symbols"].index(v))
        case "fixed":
            if len(v) != kind["size"]:
                raise ValueError(f"expected {kind['size']} bytes")
            return bytes(v)
        case other:
            return _avro(other, v)


def avro_record(fields: list[tuple[str, str | dict | list, bool]]) -> Column:
    """Avro's binary form of a record, from columns: (name, type, nullable); a null in a field that has none fails.

    The type is a name, or an object or union as in an Avro schema; nullable stands for a union with null first.
    """

    @F.arrow_udf("binary")
    def run(rows: pa.Array) -> pa.Array:
        # From Arrow, not pandas: beside a null, pandas would make floats of long numbers.
        def one(row: dict) -> bytes:
            out = b""
            for name, kind, nullable in fields:
                v = row[name]
                if v is None and not nullable and not isinstance(kind, list):
                    raise ValueError(f"{name} is required")
                out += b"\0" if v is None and nullable else (b"\2" if nullable else b"") + _avro(kind, v)
            return out

        return pa.array([one(r) for r in rows.to_pylist()], pa.binary())

    return run(F.struct(*(F.col(n) for n, _, _ in fields)))
