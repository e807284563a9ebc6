"""Reading a time window of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from driftline.functions.time import utc_of_number, utc_of_text


def window(df: DataFrame, ts: str, columns: list[str], since: str, until: str) -> DataFrame:
    """columns of the rows with since <= ts < until; both bounds and the columns reach a Parquet scan."""
    if not columns:
        raise ValueError("no columns")
    return df.where((F.col(ts) >= F.to_timestamp_ntz(F.lit(since))) & (F.col(ts) < F.to_timestamp_ntz(F.lit(until)))).select(*columns)


def jdbc_slices(spark: SparkSession, url: str, table: str, ts: str, slices: DataFrame, options: dict | None = None) -> DataFrame:
    """A JDBC table by time slices, one partition each; slices is a small table (start, end)."""
    predicates = [f"\"{ts}\" >= TIMESTAMP '{r['start']}' AND \"{ts}\" < TIMESTAMP '{r['end']}'" for r in slices.collect()]
    return spark.read.jdbc(url, table, predicates=predicates, properties=options or {})


def cast_columns(df: DataFrame, columns: list[str], times: set[str] = frozenset(), whole: set[str] = frozenset()) -> DataFrame:
    """The columns in this order: times in UTC without zone, whole numbers as long, others as they are.

    What can't be cast is null, and so is a column that df does not have.
    """

    def one(c: str):
        if c not in df.columns:
            return F.lit(None).cast("timestamp_ntz" if c in times else "bigint" if c in whole else "string")
        kind = df.schema[c].dataType
        if c in whole:
            return F.col(c).try_cast("bigint")
        if c in times and isinstance(kind, T.StringType):
            return utc_of_text(F.col(c))
        if c in times and isinstance(kind, T.NumericType):
            return utc_of_number(F.col(c))
        if c in times and isinstance(kind, T.TimestampType):
            return F.to_timestamp_ntz(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz")))
        return F.col(c)

    return df.select(*(one(c).alias(c) for c in columns))
