"""A data source that reads a time window of a database table slice by slice.

    spark.dataSource.register(TimeSlices)
    rows = spark.read.format("time_slices").schema("id long, ts timestamp_ntz").options(table=..., ts="ts", ...).load()
    rows.where((rows.ts >= since) & (rows.ts < until))

Spark hands the bounds of the window to the source, which plans a partition for each slice of a grid; tasks read the
slices side by side, halve one that the database refuses, and wait where it can't be halved any more.
"""

from __future__ import annotations

import importlib
import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: What an error says when the database has too much to do; all texts of one entry must be in it.
OVERLOADED = (("rejectedexecutionexception",), ("jobmanager", "rejected"))
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_LEAST = timedelta(microseconds=1)


class TooManyRows(Exception):
    """A slice holds more rows than a reader may keep."""


@dataclass
class Slice(InputPartition):
    """[start, end) of the window."""

    start: datetime
    end: datetime


@dataclass
class Limits:
    """minutes of a slice (0: one for the window); when and how often to halve; how often to try; rows of a slice (0: any number)."""

    minutes: int = 5
    least_minutes: int = 2
    depth: int = 3
    attempts: int = 4
    wait: float = 2.0
    rows: int = 0


def overloaded(error: Exception) -> bool:
    said = str(error).lower()
    return isinstance(error, TooManyRows) or any(all(t in said for t in texts) for texts in OVERLOADED)


def grid(since: datetime, until: datetime, minutes: int) -> Iterator[Slice]:
    """Slices that end at multiples of the minutes in a day, as functions.time.slices_of() with "ceil" makes them."""
    at = since
    while at < until:
        end = until
        if minutes > 0:
            midnight = at.replace(hour=0, minute=0, second=0, microsecond=0)
            end = midnight + timedelta(minutes=-(-(at.hour * 60 + at.minute) // minutes) * minutes)
            end = min(until, end if end > at else at + timedelta(minutes=minutes))
        yield Slice(at, end)
        at = end


def pull(fetch: Callable[[datetime, datetime], list], part: Slice, limits: Limits, depth: int = 0, sleep: Callable[[float], None] = time.sleep) -> Iterator:
    """What fetch gives for the slice; if that is refused, for its halves; if it can't be halved, after a while again.

    fetch returns a slice whole, so that nothing is given twice. A slice is halved while it is longer than the least
    length and not halved too often; every other error is raised at once, a refusal after the last attempt.
    """
    attempt = 1
    while True:
        try:
            yield from fetch(part.start, part.end)
            return
        except Exception as e:
            if not overloaded(e):
                raise
            span = part.end - part.start
            if span // timedelta(minutes=1) > limits.least_minutes and depth < limits.depth:
                middle = part.start + span / 2
                break
            if attempt >= limits.attempts:
                raise
        sleep(limits.wait * 2 ** (attempt - 1) + random.uniform(0, limits.wait / 4))
        attempt += 1
    for half in (Slice(part.start, middle), Slice(middle, part.end)):
        yield from pull(fetch, half, limits, depth + 1, sleep)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class Database:
    """A table behind a Python database driver: `module:function` with arguments makes a connection with `?` parameters."""

    def __init__(self, driver: str, arguments: dict, table: str, ts: str, columns: list[str], rows: int, size: int) -> None:
        module, _, name = driver.partition(":")
        self.connection = getattr(importlib.import_module(module), name or "connect")(**arguments)
        self.query = f"SELECT {', '.join(map(_quoted, columns))} FROM {table} WHERE {_quoted(ts)} >= ? AND {_quoted(ts)} < ? ORDER BY {_quoted(ts)}"
        self.rows, self.size = rows, size

    def fetch(self, start: datetime, end: datetime) -> list[list[tuple]]:
        """The rows of a slice in portions; TooManyRows beyond the limit."""
        cursor, out, n = self.connection.cursor(), [], 0
        try:
            cursor.execute(self.query, (start, end))
            while portion := cursor.fetchmany(self.size):
                out.append(portion)
                n += len(portion)
                if self.rows and n > self.rows:
                    raise TooManyRows(f"more than {self.rows} rows from {start} to {end}")
        finally:
            cursor.close()
        return out


class SliceReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.options, self.ts = schema, options, options["ts"]
        self.limits = Limits(**{k: type(getattr(Limits, k))(options[k]) for k in ("minutes", "least_minutes", "depth", "attempts", "wait", "rows") if k in options})
        stamp = lambda k: datetime.fromisoformat(options[k]) if k in options else None
        self.since, self.until = stamp("since"), stamp("until")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of the time column narrow the window; the others stay with Spark."""
        for f in filters:
            bound = getattr(f, "value", None)
            if getattr(f, "attribute", None) != (self.ts,) or not isinstance(bound, datetime):
                yield f
            elif isinstance(f, (GreaterThanOrEqual, GreaterThan)):
                bound += _LEAST * isinstance(f, GreaterThan)  # timestamps have whole microseconds
                self.since = bound if self.since is None else max(self.since, bound)
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                bound += _LEAST * isinstance(f, LessThanOrEqual)
                self.until = bound if self.until is None else min(self.until, bound)
            else:
                yield f

    def partitions(self) -> list[Slice]:
        if self.since is None or self.until is None:
            raise ValueError(f"a window of {self.ts} needs both bounds, as filters or as the options since and until")
        return list(grid(self.since, self.until, self.limits.minutes))

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        shape = to_arrow_schema(self.schema)
        o = self.options
        db = Database(o["driver"], json.loads(o.get("arguments", "{}")), o["table"], self.ts, self.schema.names, self.limits.rows, int(o.get("fetch", "5000")))
        try:
            for rows in pull(db.fetch, part, self.limits):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)
        finally:
            db.connection.close()


class TimeSlices(DataSource):
    """Options: driver, arguments (JSON), table, ts; minutes, least_minutes, depth, attempts, wait, rows, fetch; since, until."""

    @classmethod
    def name(cls) -> str:
        return "time_slices"

    def reader(self, schema: StructType) -> SliceReader:
        return SliceReader(schema, dict(self.options))


def database_window(spark: SparkSession, schema: str | StructType, since: str, until: str, ts: str, **options: object) -> DataFrame:
    """The rows of a database table with since <= ts < until, read by slices; columns are those of the schema.

    The bounds are filters that Spark pushes down to the source; the setting that allows this is switched on.
    """
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(TimeSlices)
    rows = spark.read.format("time_slices").schema(schema).options(ts=ts, **{k: v if isinstance(v, str) else json.dumps(v) for k, v in options.items()}).load()
    return rows.where((F.col(ts) >= F.to_timestamp_ntz(F.lit(since))) & (F.col(ts) < F.to_timestamp_ntz(F.lit(until))))
