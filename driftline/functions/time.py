"""Time functions as Spark expressions; all but local_date() work on TIMESTAMP_NTZ, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

#: Greater numbers are milliseconds, not seconds.
MS_FROM = 10_000_000_000
ANCHOR_MONDAY = "1970-01-05"
#: In microseconds.
MINUTE, DAY = 60_000_000, 86_400_000_000


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    seconds = F.unix_date(F.to_date(ts)) * F.lit(86400).cast("long") + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def from_epoch_us(us: Column) -> Column:
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=(us / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))


def floor_ms(ts: Column) -> Column:
    """ts without what is finer than a millisecond."""
    return from_epoch_us(F.floor(epoch_us(ts) / 1000) * 1000)


def from_epoch_any(v: Column) -> Column:
    """A number of seconds, or of milliseconds if it is greater than MS_FROM."""
    return from_epoch_us(F.when(v > MS_FROM, v * 1000).otherwise(v * 1_000_000))


def from_text(s: Column) -> Column:
    """Blank: null; digits: as from_epoch_any(); ISO date and time with an optional zone, as UTC; anything else: null."""
    t = F.trim(s)
    zone = F.regexp_extract(t, r"(Z|[+-]\d{2}:?\d{2})$", 1)
    plain = F.replace(F.regexp_replace(t, r"(Z|[+-]\d{2}:?\d{2})$", ""), F.lit("T"), F.lit(" "))
    minutes = F.when(zone.isin("", "Z"), 0).otherwise((F.substring(zone, 2, 2).cast("int") * 60 + F.right(zone, F.lit(2)).cast("int")) * F.when(zone.startswith("-"), -1).otherwise(1))
    stamp = F.when(plain.rlike(r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"), plain).try_cast("timestamp_ntz") - F.make_dt_interval(mins=minutes)
    return F.when(t.rlike(r"^\d{1,16}$"), from_epoch_any(F.when(t.rlike(r"^\d{1,16}$"), t).try_cast("long"))).otherwise(stamp)


def utc_of_number(v: Column) -> Column:
    """A number of seconds, fractions included, or of milliseconds if it is greater than 10**12."""
    return from_epoch_us((F.when(v > 10**12, v * 1000).otherwise(v * 1_000_000)).cast("long"))


def utc_of_text(s: Column) -> Column:
    """A date and a time with a blank or a T between, a fraction of any length and a Z; anything else, other zones too: null."""
    t = F.regexp_replace(F.replace(F.trim(s), F.lit("T"), F.lit(" ")), r"\.?Z?$", "")
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?$"), t).try_cast("timestamp_ntz")


def part_of(ts: Column) -> Column:
    """The day partition YYYYMMDD of a UTC timestamp."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def local_date(ts: Column, zone: str) -> Column:
    """The date in a business zone of a UTC timestamp without zone."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts))


def grid_slot(ts: Column, minutes: int) -> Column:
    """The start of ts's slot in a grid of minutes that begins anew each midnight."""
    us = epoch_us(ts)
    return from_epoch_us(us - F.pmod(F.pmod(us, F.lit(DAY)), F.lit(minutes * MINUTE)))


def floor_days(ts: Column, days: int) -> Column:
    """The first date of ts's interval of so many days, counted from a Monday."""
    since = F.date_diff(F.to_date(ts), F.lit(ANCHOR_MONDAY).cast("date"))
    return F.date_add(F.lit(ANCHOR_MONDAY).cast("date"), (F.floor(since / days) * days).cast("int"))


def normal_offset(s: Column) -> Column:
    """A zone's offset with minutes and a colon: +05 and +0500 become +05:00."""
    return F.regexp_replace(F.regexp_replace(s, r"([+-]\d{2})$", "$1:00"), r"([+-]\d{2})(\d{2})$", "$1:$2")


def _inner_bounds(lo: Column, hi: Column, minutes: int, grid: str) -> Column:
    """The bounds of slices between lo and hi (microseconds), in order, as an array."""
    us, none = minutes * MINUTE, F.array().cast("array<bigint>")
    run = lambda first, end: F.when(first < end, F.sequence(first, end - 1, F.lit(us).cast("long"))).otherwise(none)
    if minutes <= 0:
        return none
    if grid == "start":
        return run(lo + us, hi)
    midnight = lo - F.pmod(lo, F.lit(DAY))
    if grid == "floor":
        return run(lo - F.pmod(lo - midnight, F.lit(us)) + us, hi)
    if minutes * MINUTE > DAY:
        raise ValueError("a grid of ends needs a step of a day at most")
    minute = lo - F.pmod(lo, F.lit(MINUTE))
    behind = F.pmod(minute - midnight, F.lit(us))
    first = F.when(behind == 0, lo + us).otherwise(minute - behind + us)
    if DAY % us == 0:
        return run(first, hi)
    last = (DAY - MINUTE) // us * us  # the last bound of a full day; the step from it ends `carried` after midnight
    next_day, carried = midnight + DAY, last + us - DAY
    days = F.when(next_day < hi, F.sequence(next_day, hi - 1, F.lit(DAY))).otherwise(none)
    of_day = lambda d: F.concat(F.when(d > next_day, F.array(d + carried)).otherwise(none), F.sequence(d + us, d + last, F.lit(us).cast("long")))
    return F.filter(F.concat(run(first, next_day + us), F.flatten(F.transform(days, of_day))), lambda p: p < hi)


def _dealt(windows: DataFrame) -> DataFrame:
    """windows over as many tasks as a shuffle has: a table of few bytes is left in one task, but each window makes many rows."""
    return windows.repartition(int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def slices_of(windows: DataFrame, minutes: int, grid: str = "start", since: str = "since", until: str = "until", earlier: int = 0) -> DataFrame:
    """windows, a row for each slice of [since, until) with its start and end (timestamps without zone).

    grid "start": equal steps from since. "floor": bounds are multiples of the step from the midnight before since.
    "ceil": a slice ends at the next multiple of the step in its own day (at the next day's minutes where it passes
    midnight; from there the next multiple counts again), and a since on a multiple with seconds keeps these seconds
    until a bound is off the grid. The last slice is clipped. minutes <= 0 gives one slice; an empty or null window none.
    The first slice of each window begins `earlier` minutes before since, to read late rows again.
    """
    return _slices_of(_dealt(windows), minutes, grid, since, until, earlier)


def _slices_of(windows: DataFrame, minutes: int, grid: str, since: str = "since", until: str = "until", earlier: int = 0) -> DataFrame:
    lo, hi = epoch_us(F.col(since)), epoch_us(F.col(until))
    inner = _inner_bounds(lo, hi, minutes, grid)
    pairs = F.arrays_zip(F.concat(F.array(lo - F.lit(earlier * MINUTE)), inner).alias("a"), F.concat(inner, F.array(hi)).alias("b"))
    rows = windows.where(F.col(since) < F.col(until)).select("*", F.explode(pairs).alias("_slice"))
    return rows.select(*windows.columns, from_epoch_us(F.col("_slice.a")).alias("start"), from_epoch_us(F.col("_slice.b")).alias("end"))


def _one_window(spark: SparkSession, since: str, until: str) -> DataFrame:
    return spark.range(1).select(F.to_timestamp_ntz(F.lit(since)).alias("since"), F.to_timestamp_ntz(F.lit(until)).alias("until"))


def slices(spark: SparkSession, since: str, until: str, minutes: int, grid: bool = False) -> DataFrame:
    """start, end of the slices of one window, from since or (with grid) at multiples of the step from midnight; see slices_of()."""
    return _slices_of(_one_window(spark, since, until), minutes, "floor" if grid else "start").select("start", "end")


def ceil_slices(spark: SparkSession, since: str, until: str, minutes: int) -> DataFrame:
    """start, end of the slices of one window that end on a grid; see slices_of()."""
    return _slices_of(_one_window(spark, since, until), minutes, "ceil").select("start", "end")


def overlapped(slices: DataFrame, minutes: int, of: list[str] = ()) -> DataFrame:
    """slices, of which the first (of each window, told by the columns `of`) begins so many minutes earlier to read late rows again."""
    first = slices.groupBy(*of).agg(F.min("start").alias("_first"))
    both = slices.join(first, list(of)) if of else slices.crossJoin(F.broadcast(first))  # one row without `of`
    start = F.when(F.col("start") == F.col("_first"), F.col("start") - F.make_dt_interval(mins=F.lit(minutes))).otherwise(F.col("start"))
    return both.withColumn("start", start).select(slices.columns)


def days_of(windows: DataFrame, zone: str, since: str = "since", until: str = "until") -> DataFrame:
    """windows, a row for each local day that [since, until) touches, with its part."""
    return _days_of(_dealt(windows), zone, since, until)


def _days_of(windows: DataFrame, zone: str, since: str = "since", until: str = "until") -> DataFrame:
    days = F.sequence(local_date(F.col(since), zone), local_date(F.col(until) - F.make_dt_interval(secs=F.lit(0.001)), zone))
    rows = windows.where(F.col(since) < F.col(until)).select("*", F.explode(days).alias("_day"))
    return rows.select(*windows.columns, part_of(F.col("_day")).alias("part"))


def days_between(spark: SparkSession, since: str, until: str, zone: str) -> DataFrame:
    """part of each local day that one window touches."""
    return _days_of(_one_window(spark, since, until), zone).select("part")
