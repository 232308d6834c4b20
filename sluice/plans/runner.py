"""Run a dataset through ordered steps described by a plain dict."""

from __future__ import annotations

import json
import threading
import uuid
from functools import partial, reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.scalar import metadata_path, normalize_path
from sluice.operators.progress import MANIFEST, manifest_from_output
from sluice.operators.refs import valid_refs
from sluice.plans.registry import apply_operators, get_operator
from sluice.plans.runlog import RunLog, StreamProgress, counted, run_log, run_states, step_name
from sluice.sinks.files import READ_BACK, write_any
from sluice.sources.files import (
    CORRUPT, JSONL_GLOB, REST, all_files, as_struct, existing_refs, infer_schema, list_files, path_exists, read_any, read_by_index, read_jsonl, read_written,
)
from sluice.streaming.steps import ERROR_COLUMNS, PacedDrain, Stopped, drain_chain, side_path, run_stream_step, stream_any, stream_jsonl, stream_sink_files

TRIGGERS = ("job_finished", "file_success")
ENGINES = {"batch": ("spark-cpu-batch", "local-cpu-batch", "batch"),
           "stream": ("spark-cpu-stream", "ray-gpu-stream", "stream")}


def engine_of(step: dict[str, Any]) -> str:
    name = step.get("engine_type", "batch")
    for engine, names in ENGINES.items():
        if name in names:
            return engine
    raise ValueError(f"unknown engine {name!r}; known: {[n for ns in ENGINES.values() for n in ns]}")


#: Settings of a step that take effect. Sizing of clusters belongs to the session, so names with a dot (Spark settings) and the
#: cluster profile are accepted and left to it; a file source is a stream in any case.
STEP_SETTINGS = {"maxFilesPerTrigger", "maxOffsetsPerTrigger", "trigger_interval", "materialize", "output_compression", "partition_by", "side_output"}
SESSION_SETTINGS = {"spark_conf_name", "input_as_stream"}
DATASET_SETTINGS = {"input_path", "input_type", "input_format", "output_path", "output_format", "schema", "glob", "recursive", "root",
                    "on_error", "options", "open_records"}


def check_config(config: dict[str, Any]) -> list[dict[str, Any]]:
    """Steps of a config, after its engines, triggers and operator names are known to be valid."""
    if config["dataset"].get("input_type", "data") not in ("data", "index"):
        raise ValueError("input_type is data or index")
    unknown = set(config["dataset"]) - DATASET_SETTINGS
    if unknown:
        raise ValueError(f"unknown dataset settings {sorted(unknown)}; known: {sorted(DATASET_SETTINGS)}")
    data_format = config["dataset"].get("input_format", "jsonl")
    if config["dataset"].get("open_records") and (data_format != "jsonl" or config["dataset"].get("input_type", "data") == "index"):
        raise ValueError("open_records belongs to a folder of JSONL files")
    if config["dataset"].get("options") and config["dataset"].get("input_type", "data") == "data" and data_format == "jsonl":
        raise ValueError("reader options (dataset.options) belong to an input_format other than jsonl, or to an index")
    steps = config["steps"]
    if not steps:
        raise ValueError("a run needs at least one step")
    for step in steps:
        engine_of(step)
        if step.get("trigger_event", "job_finished") not in TRIGGERS:
            raise ValueError(f"unknown trigger {step['trigger_event']!r}; known: {TRIGGERS}")
        conf = step.get("engine_config", {})
        unknown = {k for k in conf if "." not in k} - STEP_SETTINGS - SESSION_SETTINGS
        if unknown:
            raise ValueError(f"unknown engine_config settings {sorted(unknown)}; known: {sorted(STEP_SETTINGS)}")
        if conf.get("trigger_interval") and engine_of(step) != "stream":
            raise ValueError("trigger_interval belongs to stream steps")
        if conf.get("side_output") and (engine_of(step) != "stream" or conf.get("partition_by")):
            raise ValueError("side_output belongs to stream steps without partition_by")
        for op in step["operators"]:
            get_operator(op["name"], op.get("params"))
    return steps


def output_paths(output_path: str, run_id: str, n_steps: int) -> list[str]:
    """``<out>/<run>/step_<i>`` for inner steps and ``<out>/<run>/final_output`` for the last: a run shares nothing with another."""
    base = f"{output_path.rstrip('/')}/{run_id}"
    return [f"{base}/step_{i}" for i in range(1, n_steps)] + [f"{base}/final_output"]


def manifest_path(output_path: str, run_id: str) -> str:
    return f"{output_path.rstrip('/')}/{run_id}/_manifest"


def _index_rows(spark: SparkSession, dataset: dict[str, Any]) -> DataFrame:
    index = read_any(spark, dataset["input_path"], dataset.get("input_format"), **dataset.get("options", {}))
    if "track_id" not in index.columns:
        index = index.withColumn("track_id", F.lit(None).cast("string"))
    return index


def _read_input(spark: SparkSession, dataset: dict[str, Any]) -> DataFrame:
    if dataset.get("input_type", "data") == "index":
        index = _index_rows(spark, dataset)
        if dataset.get("root"):
            index = valid_refs(index, list_files(spark, dataset["root"], recursive=True))
            return read_by_index(spark, index, dataset["schema"], dataset["root"], dataset.get("on_error", "fail"))
        return read_by_index(spark, index, dataset["schema"], on_error=dataset.get("on_error", "fail"), by_name=True)
    path, fmt = dataset["input_path"], dataset.get("input_format", "jsonl")
    if fmt != "jsonl":
        options = ({"recursiveFileLookup": "true"} if dataset.get("recursive") else {}) | dataset.get("options", {})
        rows = read_any(spark, path, fmt, dataset.get("schema"), **options)
        return rows.select("*", metadata_path(F.col("_metadata.file_path")).alias("input_file"))
    glob = dataset.get("glob", JSONL_GLOB)
    return read_jsonl(spark, path, dataset.get("schema"), dataset.get("recursive", False), dataset.get("on_error", "fail"),
                      keep_file=True, glob=glob, open_records=dataset.get("open_records", False))


def _batch_inputs(spark: SparkSession, dataset: dict[str, Any]) -> DataFrame:
    """``input_file`` of the files that a batch reads; references of an index to files that do not exist are no inputs."""
    if dataset.get("input_type", "data") == "index":
        index = _index_rows(spark, dataset)
        if dataset.get("root"):
            index = valid_refs(index, all_files(spark, dataset["root"], recursive=True), path_col="input_file")
        named = index.select(normalize_path(F.col("input_file")).alias("input_file")).distinct()
        return named if dataset.get("root") else existing_refs(spark, named)
    glob = dataset.get("glob", JSONL_GLOB) if dataset.get("input_format", "jsonl") == "jsonl" else "*"
    return all_files(spark, dataset["input_path"], glob, dataset.get("recursive", False))


def _stream_input(spark: SparkSession, dataset: dict[str, Any], files_per_batch: int | None) -> tuple[Any, T.StructType]:
    """A function that starts the input as a stream, and the schema of its rows. The same settings hold as for a batch."""
    path, fmt, recursive = dataset["input_path"], dataset.get("input_format", "jsonl"), dataset.get("recursive", False)
    if fmt == "jsonl":
        glob, on_error = dataset.get("glob", JSONL_GLOB), dataset.get("on_error", "drop")
        schema = as_struct(dataset.get("schema") or infer_schema(spark, path, glob, recursive))
        open_records = dataset.get("open_records", False)
        source = partial(stream_jsonl, spark, path, schema, files_per_batch, on_error, glob, recursive, open_records)
        extra = [T.StructField(CORRUPT, T.StringType())] if on_error == "quarantine" else []
        extra += [T.StructField(REST, T.VariantType())] if open_records else []
    else:
        options = ({"recursiveFileLookup": "true"} if recursive else {}) | dataset.get("options", {})
        schema = as_struct(dataset["schema"]) if dataset.get("schema") else read_any(spark, path, fmt, **options).schema
        source, extra = partial(stream_any, spark, path, fmt, schema, files_per_batch, recursive, **options), []
    return source, T.StructType([*schema.fields, *extra, T.StructField("input_file", T.StringType())])


class Run:
    """A run of all steps, in the caller's thread (:meth:`run`) or beside it (:meth:`start`, :meth:`wait`).

    :meth:`stop` lets the micro-batches that are running be committed and ends the run as ``stopped``; a batch step ends first. Another
    run of the same id goes on from the same checkpoints. The log of the run (:func:`sluice.plans.runlog.run_states`) and its manifest can
    be read at any time, by anyone who reaches the folder.
    """

    def __init__(self, spark: SparkSession, config: dict[str, Any], run_id: str = "run") -> None:
        self._spark, self._config, self._run_id = spark, config, run_id
        self._steps = check_config(config)
        self._out = config["dataset"].get("output_path")
        if not self._out and "stream" in map(engine_of, self._steps):
            raise ValueError("stream steps need dataset.output_path")
        self._stopping = threading.Event()
        self._thread: threading.Thread | None = None
        self._rows: DataFrame | None = None
        self._error: BaseException | None = None

    def start(self) -> Run:
        """Begin in a thread of its own."""
        self._thread = threading.Thread(target=self._guarded, name=f"run {self._run_id}", daemon=True)
        self._thread.start()
        return self

    def _guarded(self) -> None:
        try:
            self._rows = self.run()
        except BaseException as error:  # raised again where the caller waits
            self._error = error

    def stop(self) -> None:
        """Ask the run to end after what it is working on; :meth:`wait` returns when it has."""
        self._stopping.set()

    def wait(self, timeout: float | None = None) -> DataFrame | None:
        """Rows of the last step, or None if the run was stopped; a failure is raised here."""
        self._thread.join(timeout)
        if self._thread.is_alive():
            raise TimeoutError(f"run {self._run_id!r} is still running")
        if self._error:
            raise self._error
        return self._rows

    def states(self) -> DataFrame:
        """State, micro-batches and rows of every step so far."""
        return run_states(self._spark, self._out, self._run_id)

    def run(self) -> DataFrame | None:
        spark, dataset = self._spark, self._config["dataset"]
        if not self._out:
            rows = _read_input(spark, dataset)
            for step in self._steps:
                rows = apply_operators(rows, step["operators"])
            return rows
        log = RunLog(spark, self._out, self._run_id)
        names = {f"{self._run_id}-{i + 1}-{uuid.uuid4().hex[:8]}": i for i in range(len(self._steps))}
        listener = StreamProgress(log, names)
        log.add("planned", steps=len(self._steps), format=dataset.get("output_format", "json"))
        spark.streams.addListener(listener)
        try:
            rows = self._all(log, list(names))
        except Stopped:
            for i in log.started - log.ended:
                log.add("stopped", i)
            log.add("stopped")
            return None
        except BaseException as error:
            for i in log.started - log.ended:  # a failed step has told so itself; those beside it were stopped
                log.add("stopped", i)
            log.add("failed", message=_message(error))
            raise
        finally:
            spark.streams.removeListener(listener)
        log.add("success")
        return rows

    def _all(self, log: RunLog, names: list[str]) -> DataFrame:
        spark, steps, dataset, out, run_id = self._spark, self._steps, self._config["dataset"], self._out, self._run_id
        engines = [engine_of(s) for s in steps]
        fmt = dataset.get("output_format", "json")
        roots = output_paths(out, run_id, len(steps))
        split = [bool(s.get("engine_config", {}).get("side_output")) for s in steps]
        paths = [side_path(p, "good") if two else p for p, two in zip(roots, split)]  # that the next step reads
        consumed, checkpoints = inputs_path(out, run_id), f"{out.rstrip('/')}/{run_id}/_checkpoints"
        rows: DataFrame | None = None  # batch plan not written yet
        schema: T.StructType | None = None  # of the last written step
        chain: list[tuple[int, Any]] = []  # stream steps that run side by side
        planned: list[int] = []  # steps of that plan
        schemas: dict[int, T.StructType] = {}

        def load(i: int) -> DataFrame:
            return _read_output(spark, paths[i], fmt, schema).select(*[F.col(f"`{c}`") for c in schema.names])

        def ends_plan(i: int) -> bool:
            return i == len(steps) - 1 or steps[i].get("engine_config", {}).get("materialize") or engines[i + 1] == "stream"

        def complete(i: int) -> bool:
            feeds_stream = i + 1 < len(steps) and engines[i + 1] == "stream"
            return feeds_stream and path_exists(spark, f"{paths[i]}/_SUCCESS")

        def begin(i: int, source: str, made: T.StructType | None = None) -> None:
            where = {"path": paths[i], "format": fmt, "schema": made.json()} if made is not None else {}
            log.add("started", i, source=source, **where)

        def store(i: int, df: DataFrame) -> T.StructType:
            conf = steps[i].get("engine_config", {})
            begin(i, "batch", df.schema)
            if not complete(i):
                write_any(df, paths[i], fmt, compression=conf.get("output_compression"), partition_by=conf.get("partition_by"))
            for k in planned:
                log.add("success", k)
            planned.clear()
            return df.schema

        def drain() -> None:
            places, starters = [i for i, _ in chain], [start for _, start in chain]
            chain.clear()

            def ended(k: int, query: Any, error: BaseException | None) -> None:
                for progress in query.recentProgress if query is not None else []:
                    log.batch(places[k], json.loads(progress.json) if hasattr(progress, "json") else progress)
                event = "success" if error is None else "stopped" if isinstance(error, Stopped) else "failed"
                log.add(event, places[k], **({"message": _message(error)} if event == "failed" else {}))

            drain_chain(starters, stopping=self._stopping, ended=ended)

        def checked_stop() -> None:
            if self._stopping.is_set():
                raise Stopped

        for i, step in enumerate(steps):
            conf = step.get("engine_config", {})
            from_index = i == 0 and dataset.get("input_type", "data") == "index"
            if i == 0 and (engines[0] == "stream" and not from_index or not complete(next(k for k in range(len(steps)) if ends_plan(k)))):
                write_any(_batch_inputs(spark, dataset), consumed, "parquet")
            if engines[i] == "batch" or from_index:
                drain()
                checked_stop()
                planned.append(i)
                try:
                    if not ends_plan(i):
                        begin(i, "batch")
                    if rows is None:
                        rows = _read_input(spark, dataset) if i == 0 else load(i - 1)
                    rows = apply_operators(rows, step["operators"])
                    if ends_plan(i):
                        schema, rows = store(i, rows), None
                        schemas[i] = schema
                except Exception as error:
                    for k in planned:
                        log.add("failed", k, message=_message(error))
                    raise
                continue
            if step.get("trigger_event", "job_finished") == "job_finished":
                drain()
                checked_stop()
            files_per_batch = conf.get("maxFilesPerTrigger") or conf.get("maxOffsetsPerTrigger")
            try:
                if i == 0:
                    source, sample = _stream_input(spark, dataset, files_per_batch)
                else:
                    source = partial(stream_sink_files, spark, paths[i - 1], schema, fmt, files_per_batch)
                    sample = schema
                schema = apply_operators(spark.createDataFrame([], sample), step["operators"]).schema
                if split[i]:
                    schema = T.StructType([f for f in schema.fields if f.name not in ERROR_COLUMNS])
            except Exception as error:
                log.add("failed", i, message=_message(error))
                raise

            def start(i: int = i, source: Any = source, made: T.StructType = schema) -> Any:
                begin(i, "stream", made)
                return _start(source, steps[i], roots[i], f"{checkpoints}/step_{i + 1}", fmt, names[i])

            chain.append((i, start))
            schemas[i] = schema
        drain()
        inputs = spark.read.schema("input_file string").parquet(consumed) if path_exists(spark, consumed) else None
        outputs = {i: _read_output(spark, paths[i], fmt, schemas[i]) for i in schemas}
        _write_manifest(spark, inputs, outputs, len(steps), out, run_id, log.attempts())
        return load(len(steps) - 1)


def _message(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"[:2000]


def run_steps(spark: SparkSession, config: dict[str, Any], run_id: str = "run") -> DataFrame:
    """Run all steps and return the rows of the last one.

    Neighbouring batch steps become one plan and only the last output is written, unless a step sets
    ``engine_config.materialize``. Stream steps drain their input into their own directory; with the trigger
    ``file_success`` a stream step runs next to the one before it; ``maxFilesPerTrigger`` (or ``maxOffsetsPerTrigger``, one
    offset being one file) bounds its micro-batches and ``trigger_interval`` is the least time from one to the next.
    An index is a finite table, so a first step on one always runs as a batch. Lines that cannot be decoded fail a batch and are
    dropped from a stream, unless ``dataset.on_error`` says ``drop``, ``quarantine`` or ``fail``. Settings of the reader of other
    formats (``header``, ``multiLine`` or ``escape`` of CSV) stand in the dict ``dataset.options``.

    Outputs, checkpoints, the log and the manifest of a run lie below ``<output_path>/<run_id>``. A rerun with the same ``run_id`` resumes:
    stream steps go on from their checkpoints, and a batch step in front of a stream step, whose output is complete, is not run
    again, since the stream has read its files. Use a new ``run_id`` for a new input of such a step. While a run works, after it was
    stopped or has failed, :func:`run_manifest` tells what each step has finished so far and what failed, and
    :func:`sluice.plans.runlog.run_states` the state of each step. Without ``dataset.output_path`` the run must be batch only and stays lazy.
    """
    return Run(spark, config, run_id).run()


def start_steps(spark: SparkSession, config: dict[str, Any], run_id: str = "run") -> Run:
    """Begin a run beside the caller; the handle can be asked for its states, stopped and waited for."""
    return Run(spark, config, run_id).start()


def _read_output(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """What a step wrote."""
    return read_written(spark, path, fmt, schema, **READ_BACK.get(fmt, {}))


def _start(source, step: dict[str, Any], path: str, checkpoint: str, fmt: str, name: str):
    conf = step.get("engine_config", {})
    interval = conf.get("trigger_interval")
    query = run_stream_step(source(), step["operators"], path, checkpoint, fmt, {"processingTime": interval} if interval else None,
                            conf.get("output_compression"), conf.get("partition_by"), name, counted, bool(conf.get("side_output")))
    return PacedDrain(query) if interval else query


def _made(outputs: dict[int, DataFrame], run_id: str, spark: SparkSession, attempts: dict[int, int]) -> DataFrame:
    rows = [manifest_from_output(df, run_id, step_name(run_id, i), attempt=attempts.get(i, 0)) for i, df in outputs.items() if "input_file" in df.columns]
    return reduce(DataFrame.unionByName, rows, spark.createDataFrame([], MANIFEST))


def _step_rows(spark: SparkSession, run_id: str, steps: dict[int, tuple[str, int]]) -> DataFrame:
    """A row per step: its state and attempt."""
    rows = [(run_id, step_name(run_id, i), state, attempt) for i, (state, attempt) in steps.items()]
    return spark.createDataFrame(rows, "run_id string, step_id string, state string, attempt int")


def _closed(inputs: DataFrame, made: DataFrame, steps: DataFrame) -> DataFrame:
    """``made`` and a row for every other input of the given steps, with the state of the step and no output file."""
    ended = inputs.crossJoin(F.broadcast(steps.select("run_id", "step_id", F.col("state").alias("__state"), F.col("attempt").alias("__attempt"))))
    both = made.join(ended, ["run_id", "step_id", "input_file"], "full")
    return both.select("run_id", "step_id", "input_file", "output_file", F.coalesce("state", "__state").alias("state"),
                       F.coalesce("attempt", "__attempt").alias("attempt"))


def _write_manifest(spark: SparkSession, inputs: DataFrame | None, outputs: dict[int, DataFrame], n_steps: int, out: str, run_id: str,
                    attempts: dict[int, int]) -> None:
    """One row per step, input file and output file, where the records still name their input file.

    A step that has no row of an input, because it holds none, all were dropped or the step is merged with the next one, has
    finished it without an output file. Files that came after the listing of the inputs count by what is left of them.
    """
    made = _made(outputs, run_id, spark, attempts)
    if inputs is not None:
        first = made.filter(F.col("step_id") == step_name(run_id, 0)).select("input_file").filter("input_file is not null")
        steps = _step_rows(spark, run_id, {i: ("success", attempts.get(i, 0)) for i in range(n_steps)})
        made = _closed(inputs.union(first).distinct(), made, steps)
    write_any(made, manifest_path(out, run_id), "parquet")


def inputs_path(output_path: str, run_id: str) -> str:
    return f"{output_path.rstrip('/')}/{run_id}/_inputs"


def run_inputs(spark: SparkSession, output_path: str, run_id: str = "run") -> DataFrame:
    """``run_id, step_id, input_file`` of what a run has to do, as the status tables read it."""
    steps = run_states(spark, output_path, run_id).select("run_id", "step_id")
    return spark.read.schema("input_file string").parquet(inputs_path(output_path, run_id)).crossJoin(F.broadcast(steps)).select("run_id", "step_id", "input_file")


def run_bad_rows(spark: SparkSession, output_path: str, run_id: str = "run") -> DataFrame | None:
    """Rows that steps with ``side_output`` have put aside, with their ``step_id`` and what was wrong; None where no step has any."""
    found = []
    for event in run_log(spark, output_path, run_id).filter("event = 'started' and path is not null").dropDuplicates(["step_id"]).collect():
        if event["path"].endswith("/side=good"):
            fields = T.StructType.fromJson(json.loads(event["schema"])).fields
            schema = T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in ERROR_COLUMNS]])
            rows = _read_output(spark, event["path"].removesuffix("good") + "bad", event["format"], schema)
            found.append(rows.select(F.lit(event["step_id"]).alias("step_id"), *[F.col(f"`{c}`") for c in schema.names]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) if found else None


def run_manifest(spark: SparkSession, output_path: str, run_id: str = "run") -> DataFrame:
    """What a run has produced, as the progress and status tables read it; also of a run that works, was stopped or has failed.

    Then the committed files of each step tell what is finished, all inputs of a step that ended are, and the others of a failed step
    have failed.
    """
    events = run_log(spark, output_path, run_id).filter("event <> 'batch'").orderBy("at").collect()  # a few per step and attempt
    whole = [e["event"] for e in events if e["step_id"] is None]
    if not whole or whole[-1] == "success":
        return spark.read.schema(MANIFEST).parquet(manifest_path(output_path, run_id))
    last = {e["step_id"]: e for e in events if e["step_id"]}
    begun = {e["step_id"]: e for e in events if e["event"] == "started"}
    outputs, states, attempts = {}, {}, {}
    for step_id, event in last.items():
        i = int(step_id.rsplit("_", 1)[1]) - 1
        attempts[i] = event["attempt"]
        if event["event"] in ("success", "failed"):
            states[i] = (event["event"], event["attempt"])
        start = begun.get(step_id)
        if start and start["path"] and (event["event"] == "success" or start["source"] == "stream") and path_exists(spark, start["path"]):
            schema = T.StructType.fromJson(json.loads(start["schema"]))
            outputs[i] = _read_output(spark, start["path"], start["format"], schema)
    made = _made(outputs, run_id, spark, attempts)
    consumed = inputs_path(output_path, run_id)
    if states and path_exists(spark, consumed):
        made = _closed(spark.read.schema("input_file string").parquet(consumed), made, _step_rows(spark, run_id, states))
    return made
