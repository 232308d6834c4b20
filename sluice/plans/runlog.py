"""The log of a run: what its steps do, written to the run's folder while they do it.

Every event is a file of one line. A hundred micro-batches of a step become one file, and their own files go another hundred later, when no
reader's listing can name them any more; so a long stream leaves few files. The log needs no service: whoever can read the folder sees the state of a run, also of one that runs elsewhere or whose driver is gone.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sluice.sources.files import file_place, path_exists

#: ``at`` is in nanoseconds. Events: planned (of a run), started, batch, success, failed and stopped (of a run or a step).
EVENT = ("run_id string, step_id string, attempt int, event string, at bigint, batch_id bigint, input_rows bigint, output_rows bigint, "
         "message string, path string, format string, schema string, steps int, source string")
STATES = {"started": "running", "batch": "running", "success": "success", "failed": "failed", "stopped": "stopped"}
PER_FILE = 100
METRICS = "sluice_rows"


def log_path(output_path: str, run_id: str) -> str:
    return f"{output_path.rstrip('/')}/{run_id}/_log"


def step_name(run_id: str, i: int) -> str:
    return f"{run_id}_step_{i + 1}"


def counted(df: DataFrame) -> DataFrame:
    """Rows of a stream with their number as a metric of each micro-batch."""
    return df.observe(METRICS, F.count(F.lit(1)).alias("output_rows"))


class RunLog:
    """Appends events of one run; used by the run's own thread and by the listener of its streams."""

    def __init__(self, spark: SparkSession, output_path: str, run_id: str) -> None:
        self._spark, self._run_id, self._path = spark, run_id, log_path(output_path, run_id)
        self._lock = threading.RLock()
        self._batches: dict[int, list[dict]] = {}  # by step: events that are not in a common file yet
        self._single: dict[int, list[str]] = {}  # files of these events
        self._spent: dict[int, list[str]] = {}  # files of the events before
        self._last: dict[int, int] = {}  # batch id that came last
        self._session = uuid.uuid4().hex[:12]
        known = [r.asDict() for r in run_log(spark, output_path, run_id).filter("event = 'failed'").collect()]
        self._failures = {k: sum(r["step_id"] == k for r in known) for k in {r["step_id"] for r in known}}
        self.started: set[int] = set()
        self.ended: set[int] = set()

    def attempt(self, i: int) -> int:
        """How often the step has failed before."""
        return self._failures.get(step_name(self._run_id, i), 0)

    def attempts(self) -> dict[int, int]:
        prefix = f"{self._run_id}_step_"
        return {int(k.removeprefix(prefix)) - 1: n for k, n in self._failures.items() if k and k.startswith(prefix)}

    def _write(self, name: str, events: list[dict]) -> str:
        system, place = file_place(self._spark, f"{self._path}/{name}")
        _, hidden = file_place(self._spark, f"{self._path}/.{name}.writing")  # readers pass over it
        stream = system.create(hidden, True)
        try:
            stream.write(bytearray("".join(json.dumps(e) + "\n" for e in events).encode()))
        finally:
            stream.close()
        system.rename(hidden, place)
        return name

    def add(self, event: str, i: int | None = None, **values: Any) -> None:
        step = {} if i is None else {"step_id": step_name(self._run_id, i), "attempt": self.attempt(i)}
        row = {"run_id": self._run_id, "event": event, "at": time.time_ns(), **step, **values}
        with self._lock:
            if i is not None and event == "started":
                if i in self.started:
                    return
                self.started.add(i)
            if i is not None and event in ("success", "failed", "stopped"):
                if i in self.ended:
                    return
                self.ended.add(i)
            self._write(f"{row['at']:020d}-{uuid.uuid4().hex[:8]}.json", [row])

    def batch(self, i: int, progress: Any) -> None:
        """A micro-batch that is committed. The listener and the end of a step may both tell of it; it counts once."""
        if not progress["numInputRows"]:
            return
        metrics = (progress.get("observedMetrics") or {}).get(METRICS)
        batch_id = progress["batchId"]
        with self._lock:
            if batch_id <= self._last.get(i, -1):
                return
            self._last[i] = batch_id
            event = {
                "run_id": self._run_id, "step_id": step_name(self._run_id, i), "attempt": self.attempt(i), "event": "batch", "at": time.time_ns(),
                "batch_id": batch_id, "input_rows": progress["numInputRows"], "output_rows": metrics["output_rows"] if metrics else None}
            held, files = self._batches.setdefault(i, []), self._single.setdefault(i, [])
            held.append(event)
            files.append(self._write(f"batch-{i + 1}-{self._session}-{batch_id:09d}.json", [event]))
            if len(held) == PER_FILE:
                self._write(f"batches-{i + 1}-{self._session}-{batch_id:09d}.json", held)
                for old in self._spent.get(i, []):
                    system, place = file_place(self._spark, f"{self._path}/{old}")
                    system.delete(place, False)
                self._spent[i] = list(files)
                held.clear()
                files.clear()


class StreamProgress(StreamingQueryListener):
    """Tells the log of a run about the micro-batches of its streams, which carry the step in their name."""

    def __init__(self, log: RunLog, names: dict[str, int]) -> None:
        self._log, self._names = log, names

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        if event.progress.name in self._names:
            self._log.batch(self._names[event.progress.name], json.loads(event.progress.json))

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass


def run_log(spark: SparkSession, output_path: str, run_id: str = "run") -> DataFrame:
    """All events of a run so far, each once."""
    path = log_path(output_path, run_id)
    if not path_exists(spark, path):
        return spark.createDataFrame([], EVENT)
    return spark.read.schema(EVENT).json(path).dropDuplicates(["step_id", "event", "at"])


def run_states(spark: SparkSession, output_path: str, run_id: str = "run") -> DataFrame:
    """One row per step of a run, also while it runs and after it failed: state, attempt, micro-batches, rows and the message of a failure.

    States are pending, running, stopped, success and failed. Micro-batches and rows are those of the last start of a stream step, null for
    steps that are no stream or have not begun.
    """
    log = run_log(spark, output_path, run_id)
    planned = log.filter("event = 'planned'").agg(F.max("steps").alias("steps"))
    steps = planned.select(F.explode(F.sequence(F.lit(1), "steps")).alias("step")).select(F.format_string(f"{run_id.replace('%', '%%')}_step_%d", "step").alias("step_id"))
    own = log.filter("step_id is not null")
    last = own.groupBy("step_id").agg(F.max_by(F.struct("event", "attempt", "message", "at"), "at").alias("last"))
    begun = own.filter("event = 'started' and source = 'stream'").groupBy("step_id").agg(F.max("at").alias("begun"))
    batches = own.filter("event = 'batch'").select(F.col("step_id").alias("of"), "at", "batch_id", "input_rows", "output_rows")
    work = begun.join(batches, (F.col("of") == F.col("step_id")) & (F.col("at") >= F.col("begun")), "left").groupBy("step_id").agg(
        F.countDistinct("batch_id").alias("batches"), F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("output_rows"), F.lit(0)).alias("output_rows"))
    state = F.coalesce(*[F.when(F.col("last.event") == e, s) for e, s in STATES.items()], F.lit("pending"))
    return steps.join(last, "step_id", "left").join(work, "step_id", "left").select(
        F.lit(run_id).alias("run_id"), "step_id", state.alias("state"), F.coalesce("last.attempt", F.lit(0)).alias("attempt"),
        "batches", "input_rows", "output_rows", F.col("last.message").alias("message"))
