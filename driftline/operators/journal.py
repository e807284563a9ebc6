"""The run journal as pure functions over a small table: run_id, status, slice_start, slice_end, started_at, heartbeat_at."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from driftline.functions.time import from_text

#: Allowed changes of a run's status.
NEXT = {"planned": ("running", "skipped"), "running": ("ok", "error")}


def allowed(old: Column, new: Column) -> Column:
    return F.coalesce(F.array_contains(F.array(*(F.lit(f"{a}>{b}") for a, bs in NEXT.items() for b in bs)), F.concat(old, F.lit(">"), new)), F.lit(False))


def transition(runs: DataFrame, events: DataFrame) -> DataFrame:
    """runs after events (run_id, new_status): those allowed take effect, others leave a run as it is.

    Several events of one run count together, in the order of NEXT: running and ok lead from planned to ok. A run stays one row.
    """
    news = events.groupBy("run_id").agg(F.collect_set("new_status").alias("news"))

    def step(status: Column) -> Column:
        moves = [F.when((status == a) & F.array_contains("news", b), b) for a, bs in NEXT.items() for b in bs]
        return F.coalesce(*moves, status)

    both = runs.join(news, "run_id", "left")
    return both.withColumn("status", step(F.col("status"))).withColumn("status", step(F.col("status"))).select(runs.columns)


def without_stale(runs: DataFrame, now: Column, planned_minutes: int = 60, silent_minutes: int = 45, hard_hours: int = 12) -> DataFrame:
    """runs with those planned too long ago skipped, and those silent or running too long in error."""
    older = lambda c, m: F.col(c) < now - F.make_dt_interval(mins=F.lit(m))
    status = F.when((F.col("status") == "planned") & older("started_at", planned_minutes), "skipped")
    status = status.when((F.col("status") == "running") & (F.coalesce(older("heartbeat_at", silent_minutes), F.lit(False)) | older("started_at", 60 * hard_hours)), "error")
    return runs.withColumn("status", status.otherwise(F.col("status")))


def upsert(state: DataFrame, news: DataFrame, key: str = "process") -> DataFrame:
    """state with news merged in: a value that is null in the news keeps the old one."""
    rest = [c for c in state.columns if c != key]
    both = state.alias("s").join(news.alias("n"), key, "full")
    return both.select(key, *(F.coalesce(F.col(f"n.{c}"), F.col(f"s.{c}")).alias(c) for c in rest))


def expired_partitions(partitions: DataFrame, now: Column, days: int, last_cleaned: Column | None = None) -> DataFrame:
    """Journal partitions (name, part_end) to drop: those that ended more than `days` days before now.

    None on a day on which the last cleaning took place already; a partition without an end stays.
    """
    due = F.lit(True) if last_cleaned is None else F.coalesce(F.to_date(last_cleaned) < F.to_date(now), F.lit(True))
    return partitions.where(due & (F.col("part_end") < now - F.make_dt_interval(days=F.lit(days))))


#: Statuses of a run that is not over.
ACTIVE = ("planned", "running")
_ENDED = {"planned": "skipped", "running": "error"}


def watermarks(state: DataFrame, key: str = "process", last: str = "last_ok_end") -> DataFrame:
    """key, watermark: the end of the last window that went well, in UTC without zone; null where there is none or it is no time.

    `last` may be a timestamp, or text in ISO form with an optional zone.
    """
    at = from_text(F.col(last)) if state.schema[last].dataType.simpleString() == "string" else F.col(last)
    return state.select(key, at.alias("watermark"))


def _ended(runs: DataFrame, which: Column, now: Column) -> DataFrame:
    """runs, of which those active and chosen end: planned ones are skipped, running ones fail at `now`."""
    goes = which & F.col("ts_end").isNull() & F.col("status").isin(*ACTIVE)
    status = F.when(goes, F.when(F.col("status") == "planned", _ENDED["planned"]).otherwise(_ENDED["running"])).otherwise(F.col("status"))
    return runs.withColumns({"ts_end": F.when(goes & (F.col("status") == "running"), now).otherwise(F.col("ts_end")), "status": status})


def without_conflicts(runs: DataFrame, process: str, since: Column, until: Column, now: Column, keep: int | None = None) -> DataFrame:
    """runs after the active ones of one slice of a process ended, but for the run `keep`."""
    same = (F.col("process") == process) & (F.col("slice_start") == since) & (F.col("slice_end") == until)
    return _ended(runs, F.coalesce(same, F.lit(False)) & (F.lit(True) if keep is None else F.col("run_id") != keep), now)


def one_active(runs: DataFrame, now: Column) -> DataFrame:
    """runs with at most one active run a process: the latest by started_at, then run_id; the others end."""
    last = latest_active(runs).select("process", F.col("run_id").alias("_latest"))
    marked = runs.join(last, "process", "left")
    return _ended(marked, F.coalesce(F.col("run_id") != F.col("_latest"), F.lit(False)), now).select(runs.columns)


def latest_active(runs: DataFrame) -> DataFrame:
    """process, run_id: the active run of each process that started last, of several the one with the greater run_id."""
    active = runs.where(F.col("status").isin(*ACTIVE) & F.col("ts_end").isNull())
    return active.groupBy("process").agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))


def merged(old: Column, new: Column) -> Column:
    """Details (a map) with news: of a key in both the new value counts, null maps are empty."""
    old, new = (F.coalesce(m, F.create_map().cast("map<string,string>")) for m in (old, new))
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)
