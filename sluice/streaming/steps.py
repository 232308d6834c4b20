"""Structured Streaming: file-arrival sources, sinks and multi-step chains.

The file source discovers new files itself and the checkpoint remembers finished ones, so no queue of file
names and no progress store is needed. Where references to files do arrive as messages (Kafka), a micro-batch
reads the files its messages name.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.scalar import metadata_path, normalize_path
from sluice.operators.refs import REF_SCHEMA, file_refs, parse_file_refs
from sluice.plans.registry import apply_operators
from sluice.sinks.files import READ_BACK, WRITE_OPTIONS, json_as_text, write_any
from sluice.sources.by_reference import with_existence
from sluice.sources.files import (
    CORRUPT, JSONL_GLOB, all_files, list_files, list_folders, make_folder, parse_lines, path_exists, read_by_index, read_written, remove_folders,
)

DRAIN = {"availableNow": True}


def stream_jsonl(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    max_files_per_trigger: int | None = None,
    on_error: str = "drop",
    glob: str = JSONL_GLOB,
    recursive: bool = False,
    open_records: bool = False,
) -> DataFrame:
    """Records of JSONL files as they arrive, with their ``input_file``."""
    reader = spark.readStream.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path).select("value", metadata_path(F.col("_metadata.file_path")).alias("input_file"))
    return parse_lines(lines, schema, on_error, ["input_file"], open_records)


def stream_any(
    spark: SparkSession, path: str, fmt: str, schema: str | T.StructType, max_files_per_trigger: int | None = None,
    recursive: bool = False, **options: str,
) -> DataFrame:
    """Rows of files of any Spark format as they arrive, with their ``input_file``."""
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", str(recursive).lower())
    if fmt == "csv":
        reader = reader.option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.options(**options).load(path).select("*", metadata_path(F.col("_metadata.file_path")).alias("input_file"))


def stream_sink_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", max_files_per_trigger: int | None = None
) -> DataFrame:
    """The output directory of an earlier step as a stream; only committed files are seen."""
    options = dict(READ_BACK.get(fmt, {}))
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    return read_written(spark, path, fmt, schema, stream=True, **options).select(*[F.col(f"`{c}`") for c in schema.names])


def stream_refs(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """References from a message source; ``maxOffsetsPerTrigger`` and the like are plain options."""
    return parse_file_refs(spark.readStream.format(fmt).options(**options).load())


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    trigger: dict[str, Any] | None = None,
    compression: str | None = None,
    partition_by: list[str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start an exactly-once file sink. The default trigger drains what is there and stops."""
    df, fmt = json_as_text(df, fmt, partition_by)
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).option("path", path)
    writer = writer.options(**WRITE_OPTIONS.get(fmt, {}))
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or DRAIN)).start()


def run_stream_step(
    source: DataFrame,
    operators: list[dict[str, Any]],
    path: str,
    checkpoint: str,
    fmt: str = "json",
    trigger: dict[str, Any] | None = None,
    compression: str | None = None,
    partition_by: list[str] | None = None,
    name: str | None = None,
    then: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    side_output: bool = False,
) -> StreamingQuery:
    """Operators on a stream, and ``then`` on what they give, into a file sink. Rerunning with the same checkpoint resumes.

    With ``side_output`` rows that failed go to a place of their own (:func:`write_stream_split`).
    """
    rows = then(apply_operators(source, operators))
    if side_output:
        return write_stream_split(rows, path, checkpoint, fmt, trigger, compression, name)
    return write_stream(rows, path, checkpoint, fmt, trigger, compression, partition_by, name)


ERROR_COLUMNS = (CORRUPT, "_error", "_error_msg")


def side_path(path: str, side: str) -> str:
    return f"{path}/side={side}"


def write_stream_split(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "json",
    trigger: dict[str, Any] | None = None,
    compression: str | None = None,
    name: str | None = None,
    is_bad: Column | None = None,
) -> StreamingQuery:
    """Good and bad rows of a stream in two places, in one pass over each micro-batch.

    Bad are rows that ``is_bad`` says, by default those with text in ``_corrupt_record`` or ``_error``. A micro-batch is one write into
    ``side=good`` and ``side=bad``, below a folder of its number, and replaces these folders when it is run again.
    """
    if is_bad is None:
        marks = [F.col(c).isNotNull() for c in ERROR_COLUMNS[:2] if c in df.columns]
        if not marks:
            raise ValueError("rows without _corrupt_record or _error have no bad side; read them with quarantine")
        is_bad = reduce(Column.__or__, marks)
    for side in ("good", "bad"):
        make_folder(df.sparkSession, side_path(path, side))

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("side", F.when(is_bad, "bad").otherwise("good")).withColumn("batch", F.lit(batch_id))
        write_any(tagged, path, fmt, compression=compression, partition_by=["side", "batch"], partitionOverwriteMode="dynamic")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or DRAIN)).start()


LOG_EVERY = 20  # micro-batches whose references are put together


def _finished_refs(spark: SparkSession, log: str, batch_id: int) -> DataFrame | None:
    """References of the micro-batches before this one; every LOG_EVERY of them become one table.

    Only batches before the current one are put together: all of them are committed, so none is run again. The older tables go when the
    new one is whole, and a batch that is run again finds it.
    """
    if not batch_id or not path_exists(spark, log):
        return None
    schema = "input_file string, track_id string"
    start = batch_id - batch_id % LOG_EVERY
    whole = f"{log}/upto={start:09d}"
    singles = list_folders(spark, log, "batch=")
    older = [p for p in list_folders(spark, log, "upto=") if p < f"upto={start:09d}"]
    if start and not path_exists(spark, f"{whole}/_SUCCESS"):
        before = [f"{log}/{p}" for p in [*older[-1:], *(p for p in singles if p < f"batch={start:09d}")]]
        if before:
            spark.read.schema(schema).parquet(*before).distinct().write.mode("overwrite").parquet(whole)
    if start and path_exists(spark, f"{whole}/_SUCCESS"):
        remove_folders(spark, [f"{log}/{p}" for p in [*older, *(p for p in singles if p < f"batch={start:09d}")]])
    names = [*([whole] if path_exists(spark, f"{whole}/_SUCCESS") else []), *(f"{log}/{p}" for p in singles if f"batch={start:09d}" <= p < f"batch={batch_id:09d}")]
    return spark.read.schema(schema).parquet(*names).distinct() if names else None


def run_refs_step(
    refs: DataFrame,
    schema: str | T.StructType,
    operators: list[dict[str, Any]],
    path: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    fmt: str = "json",
    refs_out: str | None = None,
    root: str | None = None,
) -> StreamingQuery:
    """Process the files that arriving references name, each file once per ``track_id``.

    The references of a micro-batch are tested in tasks, written to the batch's own folder and read from there, so the message source is
    read once; the files are opened by tasks too, or, with the folder ``root`` above them all, scanned and joined. References
    to files that exist are logged as finished after the rows of the batch are written, and left out of later
    micro-batches; one that comes before its file leaves no mark, so it counts when it is sent again. Each micro-batch writes its
    own directory and overwrites it when replayed, so a batch that is run again after a failure leaves no duplicate rows. With
    ``refs_out`` every finished batch also writes one message per produced file there, for the next step to read with
    :func:`stream_refs` (``text``).
    """
    spark = refs.sparkSession
    log = f"{path}/_refs"

    def process(batch: DataFrame, batch_id: int) -> None:
        here = f"{path}/_arrived/batch={batch_id:09d}"
        arrived = batch.select("id", normalize_path(F.col("input_file")).alias("input_file"), "track_id").filter("input_file is not null")
        if root:
            arrived.write.mode("overwrite").parquet(here)
            mine = spark.read.schema(REF_SCHEMA).parquet(here).join(all_files(spark, root, recursive=True), "input_file", "left_semi")
        else:
            with_existence(arrived).write.mode("overwrite").parquet(here)
            mine = spark.read.schema(f"{REF_SCHEMA}, exists boolean").parquet(here).filter("exists").drop("exists")
        done = _finished_refs(spark, log, batch_id)
        if done is not None:
            done = done.withColumnRenamed("track_id", "__track")
            mine = mine.join(done, (mine.input_file == done.input_file) & mine.track_id.eqNullSafe(F.col("__track")), "left_anti")
        out = f"{path}/batch={batch_id}"
        rows = read_by_index(spark, mine, schema, root, by_name=not root, tested=True)
        apply_operators(rows, operators).write.format(fmt).options(**WRITE_OPTIONS.get(fmt, {})).mode("overwrite").save(out)
        mine.select("input_file", "track_id").write.mode("overwrite").parquet(f"{log}/batch={batch_id:09d}")
        if refs_out:
            made = list_files(spark, out, f"*.{fmt}*").select(F.col("path").alias("output_file"))
            write_any(file_refs(made, keep_fields=False), f"{refs_out}/batch={batch_id}", "text")

    writer = refs.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or DRAIN)).start()


class PacedDrain:
    """A query with an interval between its micro-batches that stops when everything there was is done."""

    def __init__(self, query: StreamingQuery) -> None:
        self._query, self._error = query, None
        self._thread = threading.Thread(target=self._drain, daemon=True)
        self._thread.start()

    def _drain(self) -> None:
        try:
            self._query.processAllAvailable()
        except Exception as error:  # raised again where the caller waits
            self._error = error
        finally:
            self._query.stop()

    @property
    def isActive(self) -> bool:
        return self._thread.is_alive()

    @property
    def lastProgress(self) -> Any:
        return self._query.lastProgress

    @property
    def recentProgress(self) -> Any:
        return self._query.recentProgress

    def stop(self) -> None:
        self._query.stop()
        self._thread.join()

    def awaitTermination(self) -> None:
        self._thread.join()
        if self._error:
            raise self._error


class Stopped(Exception):
    """A chain of steps was asked to stop, and has."""


def finish(query: StreamingQuery) -> None:
    """Wait for a draining query; its failure is raised here."""
    query.awaitTermination()


def has_output(query: StreamingQuery) -> bool:
    """Whether a query has committed at least one micro-batch."""
    return query.lastProgress is not None and query.lastProgress["batchId"] >= 0


def stop_after_batch(query: StreamingQuery, poll_seconds: float = 0.05) -> None:
    """Let the micro-batch that is running be committed, then stop. What had begun after it is undone and comes again with a resume."""
    before = query.lastProgress and query.lastProgress["batchId"]
    while query.isActive and (query.lastProgress and query.lastProgress["batchId"]) == before:
        time.sleep(poll_seconds)
    if query.isActive:
        query.stop()


def drain_chain(
    starters: list[Callable[[], StreamingQuery]],
    poll_seconds: float = 0.2,
    stopping: threading.Event | None = None,
    ended: Callable[[int, StreamingQuery | None, BaseException | None], None] | None = None,
) -> None:
    """Drain steps that run side by side, each from the first finished file of the step before it.

    A starter begins its step as a draining query on the checkpoint of that step. It is called again until one
    whole run of the step began after its upstream step was done, so no file is missed. The first failure stops
    the other steps and is raised. Once ``stopping`` is set, every step stops after its micro-batch and :class:`Stopped` is raised.
    ``ended`` is told of each step that is done, has failed or was stopped: its place in the chain, its query, and what ended it early.
    """
    n = len(starters)
    queries: list[StreamingQuery | None] = [None] * n
    final, done, produced = [False] * n, [False] * n, [False] * n
    tell = ended or (lambda i, query, error: None)
    try:
        while not all(done):
            if stopping is not None and stopping.is_set():
                for i, query in enumerate(queries):
                    if query is not None and not done[i]:
                        stop_after_batch(query)
                        tell(i, query, Stopped())
                raise Stopped
            for i, start in enumerate(starters):
                query, upstream_done = queries[i], i == 0 or done[i - 1]
                if done[i] or (query is not None and query.isActive):
                    produced[i] = produced[i] or (query is not None and has_output(query))
                    continue
                try:
                    if query is not None:
                        finish(query)
                        produced[i] = produced[i] or has_output(query)
                        done[i] = final[i]
                    if not done[i] and (upstream_done or produced[i - 1]):
                        final[i] = upstream_done
                        queries[i] = start()
                except Exception as error:
                    tell(i, query, error)
                    raise
                if done[i]:
                    tell(i, query, None)
            time.sleep(poll_seconds)
    finally:
        for query in queries:
            if query is not None and query.isActive:
                query.stop()
