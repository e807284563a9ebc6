"""The latest known value of each column, by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_values(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: of each other column the last value that is not null, by `order` (the last of which breaks ties).

    The latest row alone won't do: a null in it does not hide an older value. Spark combines on the map side, so
    what is shuffled is one row a key and task.
    """
    at = F.struct(*order)
    rest = [c for c in df.columns if c not in keys]
    value = lambda c: F.max_by(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"))), F.when(F.col(c).isNotNull(), at))["v"].alias(c)
    return df.groupBy(*keys).agg(*map(value, rest))
