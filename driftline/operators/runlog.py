"""A durable journal of runs with one writer a process: what happened, in order, and what follows from it.

Every event is one file of a commit log. A writer that decides on what it read writes the next number; if another one
was faster it reads again and decides anew, so no two runs of a process are active at once. After COMPACT events the
state is written as one event, from which later readers start.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from driftline.sources.commits import CommitLog, Taken

#: Events after which a state is written down whole, and ended runs that a state keeps.
COMPACT, KEPT = 100, 200
#: Minutes without a heartbeat after which a run counts as dead, and hours after which it does in any case.
SILENT, HARD = 45, 12

ACTIVE = "running"


class Busy(Exception):
    """Another run of the process is active."""


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunLog:
    """The journal at `path`; `clock` gives the time in UTC without zone."""

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], datetime] = utc_now) -> None:
        self.spark, self.clock, self.log = spark, clock, CommitLog(spark, path)

    def state(self) -> tuple[int, dict]:
        """The last number and {process: {"watermark": text or null, "runs": {run: {...}}}}; at most 2 * COMPACT files are read."""
        numbers = self.log.numbers()
        state: dict = {}
        events: list[dict] = []
        for n in reversed(numbers):
            e = self.log.get(n)
            if "state" in e:
                state = e["state"]
                break
            events.append(e)
        for e in reversed(events):
            _apply(state, e)
        return (numbers[-1] if numbers else 0), state

    def _write(self, decide: Callable[[dict], dict]) -> dict:
        """Append the event that `decide` makes of the state; it may raise instead."""
        while True:
            last, state = self.state()
            event = decide(state) | {"at": self.clock().isoformat()}
            try:
                self.log.put(last + 1, event)
            except Taken:
                continue
            if (last + 1) % COMPACT == 0:
                self._compact()
            return event

    def _compact(self) -> None:
        last, state = self.state()
        for p in state.values():
            ended = [r for r, run in p["runs"].items() if run["status"] != ACTIVE]
            for r in ended[: max(0, len(ended) - KEPT)]:
                del p["runs"][r]
        try:
            self.log.put(last + 1, {"state": state})
        except Taken:
            return
        for n in self.log.numbers():
            if n < last + 1 - COMPACT:  # a reader that listed before may still want the newest ones
                self.log.drop(n)

    def start(self, process: str, since: datetime, until: datetime, **details: object) -> str:
        """Begin a run over a window; Busy if one of the process is active. One that was silent too long is in error first."""
        now = self.clock()

        def decide(state: dict) -> dict:
            dead = []
            for r, run in state.get(process, {"runs": {}})["runs"].items():
                if run["status"] == ACTIVE:
                    beat, began = (datetime.fromisoformat(run[k]) for k in ("heartbeat_at", "started_at"))
                    if beat >= now - timedelta(minutes=SILENT) and began >= now - timedelta(hours=HARD):
                        raise Busy(f"{process}: run {r} is active since {began}")
                    dead.append(r)
            number = state.get(process, {}).get("count", 0) + 1
            return {"kind": "start", "process": process, "run": f"{process}-{number}", "since": since.isoformat(), "until": until.isoformat(), "dead": dead, "details": details}

        return self._write(decide)["run"]

    def _of_run(self, run: str, event: dict) -> None:
        def decide(state: dict) -> dict:
            for process, p in state.items():
                if run in p["runs"]:
                    if p["runs"][run]["status"] != ACTIVE:
                        raise ValueError(f"run {run} is over: {p['runs'][run]['status']}")
                    return event | {"process": process, "run": run}
            raise KeyError(run)

        self._write(decide)

    def slice_done(self, run: str, start: datetime, end: datetime, parts: list[int]) -> None:
        """A slice is in RAW and its days wait to be published. Also a heartbeat."""
        self._of_run(run, {"kind": "slice", "start": start.isoformat(), "end": end.isoformat(), "parts": parts})

    def published(self, run: str, parts: list[int]) -> None:
        """These days of the process wait no longer. Also a heartbeat."""
        self._of_run(run, {"kind": "published", "parts": parts})

    def beat(self, run: str) -> None:
        self._of_run(run, {"kind": "beat"})

    def finish(self, run: str) -> None:
        """The run went well: its window's end is the watermark of the process, unless that is later already."""
        self._of_run(run, {"kind": "ok"})

    def fail(self, run: str, error: str) -> None:
        """The run failed; its slices stay done, its days go on waiting."""
        self._of_run(run, {"kind": "error", "error": error})

    def watermark(self, process: str) -> datetime | None:
        """The end of the latest window that went well."""
        at = self.state()[1].get(process, {}).get("watermark")
        return datetime.fromisoformat(at) if at else None

    def done_until(self, process: str) -> tuple[datetime | None, list[int]]:
        """Where the next run goes on: the end of the last slice in RAW (else the watermark), and the days that wait to be published."""
        p = self.state()[1].get(process, {})
        ends = [t for t in (p.get("watermark"), p.get("reached")) if t]
        return (datetime.fromisoformat(max(ends)) if ends else None), sorted(p.get("waiting", []))

    def runs(self) -> DataFrame:
        """process, run, status, since, until, started_at, heartbeat_at, slices, error of the runs that are kept."""
        rows = []
        for process, p in self.state()[1].items():
            for r, run in p["runs"].items():
                times = (datetime.fromisoformat(run[k]) for k in ("since", "until", "started_at", "heartbeat_at"))
                rows.append((process, r, run["status"], *times, run["slices"], run.get("error")))
        kinds = "process string, run string, status string, since timestamp_ntz, until timestamp_ntz, started_at timestamp_ntz, heartbeat_at timestamp_ntz, slices int, error string"
        return self.spark.createDataFrame(rows, kinds)


def _apply(state: dict, e: dict) -> None:
    """The state after an event."""
    p = state.setdefault(e["process"], {"watermark": None, "reached": None, "waiting": [], "count": 0, "runs": {}})
    if e["kind"] == "start":
        for r in e["dead"]:
            p["runs"][r] |= {"status": "error", "error": "no sign of life"}
        p["count"] += 1
        p["runs"][e["run"]] = {"status": ACTIVE, "since": e["since"], "until": e["until"], "started_at": e["at"], "heartbeat_at": e["at"], "slices": 0, "details": e["details"]}
        return
    run = p["runs"][e["run"]]
    run["heartbeat_at"] = e["at"]
    match e["kind"]:
        case "slice":
            run["slices"] += 1
            p["reached"] = max(e["end"], p["reached"] or "")
            p["waiting"] = sorted({*p["waiting"], *e["parts"]})
        case "published":
            p["waiting"] = [x for x in p["waiting"] if x not in e["parts"]]
        case "ok":
            run["status"] = "ok"
            p["watermark"] = max(run["until"], p["watermark"] or "")
        case "error":
            run |= {"status": "error", "error": e["error"]}
