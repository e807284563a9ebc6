"""A table of day partitions whose publication is one step: readers see all of it or nothing.

`log/` holds numbered manifests; each names the folder of every day that has rows. Days are written to folders of their
own under `data/`, and the next manifest, written once and last, makes them the table. What no kept manifest names is
removed by vacuum().
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from driftline.operators.dedup import latest_values
from driftline.sources.commits import CommitLog, Taken

log = logging.getLogger(__name__)


class Conflict(Exception):
    """Another publication replaced one of the same days meanwhile."""


class SnapshotTable:
    """A table at `path`; `schema` without the partition column `part` (int) is needed for the first publication only."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    def manifest(self, version: int | None = None) -> dict:
        """version, schema (JSON) and parts (day: folder) of the last version or an older one; version 0 is empty."""
        if version is None:
            version = max(self.log.numbers(), default=0)
        return self.log.get(version) if version else {"version": 0, "schema": None, "parts": {}}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version with their `part`; later publications do not change what was read. Days are pruned by `part`."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise FileNotFoundError(f"{self.path} was never published")
        schema = StructType.fromJson(m["schema"])
        groups: dict[str, list[str]] = {}
        for folder in m["parts"].values():
            groups.setdefault(folder.rpartition("/")[0], []).append(folder)
        full = StructType(list(schema.fields)).add("part", IntegerType())
        rows = self.spark.createDataFrame([], full)
        for base, folders in sorted(groups.items()):  # one reader for each publication that is still in use
            rows = rows.unionByName(self.spark.read.schema(full).option("basePath", f"{self.path}/{base}").parquet(*(f"{self.path}/{f}" for f in folders)))
        return rows

    def _stage(self, rows: DataFrame, keys: list[str]) -> dict[str, str]:
        """Write rows to a folder of their own; day: folder."""
        base = f"data/{uuid.uuid4().hex}"
        rows.repartitionByRange("part", *keys).sortWithinPartitions("part", *keys).write.partitionBy("part").parquet(f"{self.path}/{base}")
        names = [n for n in self.log.folders(f"{self.path}/{base}") if n.startswith("part=")]
        return {n.removeprefix("part="): f"{base}/{n}" for n in names}

    def publish(self, raw: DataFrame, keys: list[str], order: list[str], parts: list[int]) -> tuple[list[int], list[int]]:
        """Replace these days by the deduplicated rows of RAW (which has `part`); returns the days published and those that failed.

        All days are written in one job; if it fails, one by one, so that a day that can't be written leaves the others.
        A day without rows in RAW is empty afterwards. The manifest is the only step that readers see: a run that is
        stopped before it changes nothing. Two runs at once both come through if their days differ, else Conflict.
        """
        wanted = sorted(set(parts))
        if not wanted:
            return [], []
        seen = self.manifest()
        rows = latest_values(raw.where(F.col("part").isin(wanted)), ["part", *keys], order)
        schema = StructType([f for f in rows.schema if f.name != "part"])
        staged: dict[str, str] = {}
        done, failed = wanted, []
        try:
            staged = self._stage(rows, keys)
        except Exception:
            log.warning("publication of %d days failed, going on day by day", len(wanted), exc_info=True)
            done = []
            for p in wanted:
                try:
                    staged |= self._stage(rows.where(F.col("part") == p), keys)
                    done.append(p)
                except Exception:
                    log.warning("day %d was not published", p, exc_info=True)
                    failed.append(p)
        if done:
            self._commit(seen, schema, done, staged)
        return done, failed

    def _commit(self, seen: dict, schema: StructType, done: list[int], staged: dict[str, str]) -> None:
        names = [str(p) for p in done]
        while True:
            now = self.manifest()
            if any(now["parts"].get(p) != seen["parts"].get(p) for p in names):
                raise Conflict(f"{self.path}: version {now['version']} replaced one of {done}")
            parts = {p: f for p, f in now["parts"].items() if p not in names} | staged
            try:
                self.log.put(now["version"] + 1, {"version": now["version"] + 1, "schema": json_of(schema), "parts": parts})
                return
            except Taken:
                continue

    def drop_before(self, part: int) -> list[int]:
        """The days before `part` leave the table by their names alone: no file of any day is opened."""
        while True:
            now = self.manifest()
            gone = sorted(int(p) for p in now["parts"] if int(p) < part)
            if not gone:
                return []
            kept = {p: f for p, f in now["parts"].items() if int(p) >= part}
            try:
                self.log.put(now["version"] + 1, now | {"version": now["version"] + 1, "parts": kept})
                return gone
            except Taken:
                continue

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the last `keep` versions and every folder that none of these names; returns the folders removed.

        Not to be run beside a publication: what that has staged is named by no version yet.
        """
        numbers = self.log.numbers()
        kept = numbers[-max(1, keep) :]
        used = {f for n in kept for f in self.log.get(n)["parts"].values()}
        for n in numbers[: len(numbers) - len(kept)]:
            self.log.drop(n)
        gone = []
        for base in self.log.folders(f"{self.path}/data"):
            days = [f"data/{base}/{d}" for d in self.log.folders(f"{self.path}/data/{base}")]
            if not any(d in used for d in days):
                gone.append(f"data/{base}")
            else:
                gone += [d for d in days if d not in used and "/part=" in d]
        for folder in gone:
            self.log.delete_folder(f"{self.path}/{folder}")
        return gone


def json_of(schema: StructType) -> dict:
    return schema.jsonValue()
