"""From RAW to CLEAN by whole day partitions: gating, publication, backfill, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftline.functions.time import part_of
from driftline.operators.dedup import latest_values


def gated(new_rows: DataFrame, least: int) -> DataFrame:
    """part, n_rows of the partitions that got enough new rows."""
    return new_rows.groupBy("part").agg(F.count("*").alias("n_rows")).where(F.col("n_rows") >= least)


def parts_in(raw: DataFrame, ts: str, since: str, until: str) -> DataFrame:
    """The day partitions with rows in [since, until)."""
    return raw.where((F.col(ts) >= F.to_timestamp_ntz(F.lit(since))) & (F.col(ts) < F.to_timestamp_ntz(F.lit(until)))).select(part_of(F.col(ts)).alias("part")).distinct()


def replaced(clean: DataFrame, new: DataFrame, parts: DataFrame) -> DataFrame:
    """CLEAN as it is after the partitions in `parts` were replaced by those of new (a partition without new rows is emptied)."""
    return clean.join(F.broadcast(parts), "part", "left_anti").unionByName(new.join(F.broadcast(parts), "part", "left_semi"))


def publish(raw: DataFrame, clean_path: str, keys: list[str], order: list[str], parts: list[int]) -> None:
    """Write the deduplicated rows of these partitions of RAW over those of CLEAN.

    Dynamic overwrite replaces only partitions that have rows: a partition that is empty in RAW stays as it is. Rows are
    dealt by ranges of day and keys, so that a large day is written by many tasks.
    """
    rows = latest_values(raw.where(F.col("part").isin(parts)), ["part", *keys], order)
    rows.repartitionByRange("part", *keys).sortWithinPartitions("part", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(clean_path)


def retained(df: DataFrame, ts: str, now: str, days: int) -> DataFrame:
    """Rows not older than so many days at `now`."""
    return df.where(F.col(ts) >= F.to_timestamp_ntz(F.lit(now)) - F.make_dt_interval(days=F.lit(days)))


def topic_plan(wanted: DataFrame, actual: DataFrame, increase: bool = True) -> DataFrame:
    """topic, action (create, increase, keep) of wanted (topic, partitions) against actual topics; partitions never shrink."""
    both = wanted.alias("w").join(actual.alias("a"), "topic", "left")
    action = F.when(F.col("a.partitions").isNull(), "create").when(F.lit(increase) & (F.col("w.partitions") > F.col("a.partitions")), "increase").otherwise("keep")
    return both.select("topic", action.alias("action"))


def pending(waiting: DataFrame, found: DataFrame) -> DataFrame:
    """part: all that wait to be published and all that were found in the window, each once."""
    return waiting.select("part").unionByName(found.select("part")).distinct()


def unpublished(waiting: DataFrame, published: DataFrame) -> DataFrame:
    """part: those that still wait after some were published."""
    return waiting.select("part").distinct().join(published.select("part"), "part", "left_anti")


def interval_of(parts: DataFrame) -> DataFrame:
    """since, until: from the first day of the parts to the end of the last one; null for no parts."""
    day = lambda c: F.to_timestamp_ntz(c.cast("string"), F.lit("yyyyMMdd"))
    ends = parts.agg(F.min("part").alias("a"), F.max("part").alias("b"))
    return ends.select(day(F.col("a")).alias("since"), (day(F.col("b")) + F.make_dt_interval(days=F.lit(1))).alias("until"))


def config_changes(wanted: DataFrame, actual: DataFrame) -> DataFrame:
    """topic, name, old, value: the settings (topic, name, value) of topics that are missing or differ; others stay."""
    old = actual.select("topic", "name", F.col("value").alias("old"))
    return wanted.join(old, ["topic", "name"], "left").where(~F.col("value").eqNullSafe(F.col("old"))).select("topic", "name", "old", "value")
