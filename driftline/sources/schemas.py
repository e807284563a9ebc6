"""Table schemas from Avro files or a JSON file, read on the driver."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

_AVRO = {"null": T.NullType(), "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "bytes": T.BinaryType(), "enum": T.StringType(), "fixed": T.BinaryType()}


def _kind(avro, properties: bool) -> tuple[T.DataType, bool]:
    if isinstance(avro, list):
        rest = [x for x in avro if x != "null"]
        return _kind(rest[0], properties)[0], "null" in avro
    if isinstance(avro, dict):
        if avro["type"] == "array":
            return T.ArrayType(_kind(avro["items"], properties)[0]), False
        if avro["type"] == "map":
            return T.MapType(T.StringType(), _kind(avro["values"], properties)[0]), False
        if avro["type"] == "record":
            return struct_of(avro, properties), False
        return _kind(avro["type"], properties)
    return _AVRO[avro], False


def struct_of(avro: dict, properties: bool = True) -> T.StructType:
    """A record schema as a StructType; other properties of a field are its metadata, if they are wanted."""
    fields = []
    for f in avro["fields"]:
        kind, nullable = _kind(f["type"], properties)
        fields.append(T.StructField(f["name"], kind, nullable, {k: v for k, v in f.items() if properties and k not in ("name", "type") and isinstance(v, (str, int, float, bool))}))
    return T.StructType(fields)


def avro_schema(folder: str, table: str) -> T.StructType:
    """The schema in TABLE.avsc, its name in lower case."""
    return struct_of(json.loads(Path(folder, f"{table.lower()}.avsc").read_text("utf-8")))


def json_schemas(path: str) -> dict[str, dict]:
    """table: {columns: {name: type}, pk: [...]}, by the table's name as given, upper, lower, and without a namespace."""
    root = json.loads(Path(path).read_text("utf-8-sig"))
    if not isinstance(root, dict):
        raise ValueError("the root must be an object")
    out: dict[str, dict] = {}
    for name, spec in root.items():
        entry = {"columns": {k.lower(): v for k, v in spec.get("columns", {}).items()}, "pk": [k.lower() for k in spec.get("pk", [])]}
        for alias in (name, name.rpartition(":")[2]):
            for key in (alias, alias.upper(), alias.lower()):
                out.setdefault(key, entry)
    return out
