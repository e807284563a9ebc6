"""Messages back to typed RAW rows: JSON lines and Avro in frames."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.column import Column
from pyspark.sql.pandas.types import to_arrow_type

from driftline.functions.time import from_epoch_us
from driftline.sources.avro import resolved, whole
from driftline.sources.schemas import struct_of

_BAD = "_not_json"


def timed(rows: DataFrame, millis: list[str]) -> DataFrame:
    """rows with columns of milliseconds as timestamps without zone, and null arrays empty."""
    lists = {f.name: F.coalesce(F.col(f.name), F.array().cast(f.dataType)) for f in rows.schema if isinstance(f.dataType, T.ArrayType)}
    return rows.withColumns({c: from_epoch_us(F.col(c) * 1000) for c in millis} | lists)


def json_rows(messages: DataFrame, column: str, schema: T.StructType, millis: list[str] = ()) -> DataFrame:
    """The typed rows of JSON lines, of which a message may hold several.

    A line that is no single object, does not fit the schema or lacks a required field is left out, others of its
    message stay. Unknown fields are ignored; `millis` names the columns that hold milliseconds.
    """
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema] + [T.StructField(_BAD, T.StringType())])
    lines = messages.select(F.explode(F.split(F.col(column).cast("string"), "\n")).alias("line"))
    single = F.from_json(F.concat(F.lit("["), F.col("line"), F.lit("]")), "array<map<string,string>>")  # null where anything but objects stands
    parsed = F.from_json(F.col("line"), loose, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    rows = lines.where(F.size(single) == 1).select(parsed.alias("r")).where(F.col("r").isNotNull())
    fits = rows.select("r.*").where(F.col(_BAD).isNull())
    for f in schema:
        if not f.nullable:
            fits = fits.where(F.col(f.name).isNotNull())
    return timed(fits.drop(_BAD), list(millis))


def frame_id(b: Column) -> Column:
    """The schema's id of a frame; null if it is none."""
    return F.when((F.length(b) >= 5) & (F.hex(F.substring(b, 1, 1)) == "00"), F.conv(F.hex(F.substring(b, 2, 4)), 16, 10).cast("long"))


def _used_branches(kind):
    """A reader's type with each union cut to null and the branch that its column has the type of."""
    if isinstance(kind, list):
        rest = [x for x in kind if x != "null"]
        return [_used_branches(x) for x in kind if x == "null" or x is rest[0]]
    if isinstance(kind, dict):
        inner = {k: _used_branches(v) for k, v in kind.items() if k in ("items", "values") or (k == "type" and isinstance(v, (dict, list)))}
        fields = {"fields": [f | {"type": _used_branches(f["type"])} for f in kind["fields"]]} if kind.get("type") == "record" else {}
        return kind | inner | fields
    return kind


def avro_rows(messages: DataFrame, column: str, schema: dict, millis: list[str] = (), skip: bool = False, writers: dict[int, dict] | None = None) -> DataFrame:
    """The typed rows of Avro records in frames (a zero byte, the schema's id, the record).

    Without `writers` all are written with this schema, whatever their id. With writers (id: schema) each is read with
    the one its frame names and resolved to this one. A broken message fails; with skip it is left out: no frame, an
    unknown id, a record that ends early or late, a number out of range, a branch or symbol that does not exist, a
    value that this schema can't take. Of a union the column has the type of the first branch that is not null.
    """
    made = struct_of(schema, properties=False)
    arrow = to_arrow_type(made)
    reader = _used_branches({"type": "record", "name": schema.get("name", "row"), "fields": schema["fields"]})

    @F.arrow_udf(made)
    def run(frames: pa.Array) -> pa.Array:
        known: dict[int, Callable] = {}

        def of(number: int) -> Callable:
            if number not in known:
                if writers is not None and number not in writers:
                    raise ValueError(f"no schema {number}")
                writer = schema if writers is None else writers[number]
                known[number] = resolved({"type": "record", "name": writer.get("name", "row"), "fields": writer["fields"]}, reader)
            return known[number]

        def one(frame: bytes | None) -> dict | None:
            try:
                if frame is None or len(frame) < 5 or frame[0] != 0:
                    raise ValueError("not a frame")
                return whole(of(int.from_bytes(frame[1:5], "big") if writers is not None else -1), frame[5:])
            except ValueError:
                if skip:
                    return None
                raise

        return pa.array([one(f) for f in frames.to_pylist()], arrow)

    # Not deterministic for Spark: else it decodes each message once for the filter and again for the columns.
    rows = messages.select(run.asNondeterministic()(F.col(column)).alias("r")).where(F.col("r").isNotNull())
    return timed(rows.select("r.*"), list(millis))
