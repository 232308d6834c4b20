"""A sink that writes one object per input: a data source with commit and abort, for tables and for the micro-batches of streams.

Rows are dealt out by the input that they came from, and a large input to several tasks (adaptive execution splits partitions by their
bytes). Each task writes hidden pieces, which the commit lists. Pieces of one object are put one behind the other, as lines and gzip members
may be; then all objects get their names at once. A job or micro-batch that fails leaves no named object, and one that is run again
replaces its own. Files are opened with the file systems of pyarrow, as in :mod:`sluice.sources.by_reference`.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import accumulate, groupby
from typing import Any

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.scalar import basename, normalize_path
from sluice.sinks.files import as_lines, has_rest
from sluice.sources.by_reference import BLOCK, _opened

FORMAT = "one_object_per_input"
HIDDEN = "._"


@dataclass
class Written(WriterCommitMessage):
    """The pieces of a task: hidden file, name and input of the object, bytes."""

    pieces: list[tuple[str, str, str, int]]


class PerInputWriter(DataSourceArrowWriter):
    """Writes the pieces of objects; the commit leaves their list, by which :func:`write_per_input` makes objects of them."""

    def __init__(self, path: str, attempt: str) -> None:
        self._path, self._attempt = path.rstrip("/"), attempt

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Rows (object, input, value) that come sorted by object and input."""
        system, folder = _opened(self._path)
        system.create_dir(folder, recursive=True)
        objects: list[tuple[str, str, str]] = []
        sink: Any = None
        try:
            for batch in iterator:
                for name, source, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if not objects or objects[-1][1:] != (name, source):
                        if sink is not None:
                            sink.close()
                        hidden = f"{folder}/{HIDDEN}{self._attempt}-{uuid.uuid4().hex}"
                        objects.append((hidden, name, source))
                        sink = system.open_output_stream(hidden, compression="gzip" if name.endswith(".gz") else None)
                    sink.write(value.encode() + b"\n")
        finally:
            if sink is not None:
                sink.close()
        return Written([(*o, system.get_file_info(o[0]).size) for o in objects])

    def commit(self, messages: list[Written | None]) -> None:
        pieces = sorted((piece for m in messages if m is not None for piece in m.pieces), key=lambda piece: piece[1])
        inputs: dict[str, str] = {}
        for _, name, source, _ in pieces:
            if inputs.setdefault(name, source) != source:
                self.abort(messages)
                raise ValueError(f"two inputs would be written to {name!r}: {inputs[name]!r} and {source!r}")
        system, listed = _opened(_list_of(self._path, self._attempt))
        system.create_dir(os.path.dirname(listed), recursive=True)
        with system.open_output_stream(listed, compression=None) as sink:
            sink.write(json.dumps([(name, hidden, size) for hidden, name, _, size in pieces]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        _clean(self._path, self._attempt)


def _list_of(path: str, attempt: str) -> str:
    return f"{path.rstrip('/')}/{HIDDEN}{attempt}-list"


def _clean(path: str, attempt: str) -> None:
    """Delete the hidden files of a job, also those of tasks that failed or ran twice."""
    system, folder = _opened(path.rstrip("/"))
    for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if info.base_name.startswith(f"{HIDDEN}{attempt}-"):
            system.delete_file(info.path)


def _put_together(spark: SparkSession, path: str, wholes: dict[str, list[tuple[str, int]]]) -> None:
    """Copy pieces (file, bytes) one behind the other into the files that they make up.

    Where a file system can write inside a file (local and mounted ones), each task copies one piece to its place; elsewhere one task
    streams all pieces of a file.
    """
    system, _ = _opened(path)
    inside = isinstance(system, fs.LocalFileSystem)
    rows: list[tuple[str, int, list[str]]] = []
    for whole, pieces in wholes.items():
        files, ends = [piece for piece, _ in pieces], accumulate(size for _, size in pieces)
        rows += [(whole, end - size, [piece]) for (piece, size), end in zip(pieces, ends)] if inside else [(whole, 0, files)]

    def copy(copies: Iterator[tuple[str, int, list[str]]]) -> None:
        system, _ = _opened(path)
        for whole, start, pieces in copies:
            with os.fdopen(os.open(whole, os.O_WRONLY | os.O_CREAT, 0o666), "wb") if inside else system.open_output_stream(whole, compression=None) as sink:
                if inside:
                    sink.seek(start)
                for piece in pieces:
                    with system.open_input_stream(piece, compression=None) as source:
                        while block := source.read(BLOCK):
                            sink.write(block)

    spark.sparkContext.parallelize(rows, len(rows)).foreachPartition(copy)
    for whole, pieces in wholes.items():
        size, wanted = system.get_file_info(whole).size, sum(size for _, size in pieces)
        if size != wanted:
            raise OSError(f"{whole!r} has {size} bytes of {wanted}")


class PerInputSource(DataSource):
    """The sink half of a data source; its options are the path and the name of the attempt."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: Any, overwrite: bool) -> PerInputWriter:
        return PerInputWriter(self.options["path"], self.options["attempt"])


def object_name(df: DataFrame, suffix: str) -> Column:
    """The name of a row's object: the ``track_id`` where there is one, else the base name of the input, with the suffix of the sink."""
    plain = F.regexp_replace(basename(normalize_path(F.col("input_file"))), r"(\.jsonl|\.json|\.txt)?(\.gz)?$", "")
    named = F.coalesce(F.nullif(F.replace(F.col("track_id"), F.lit("/"), F.lit("_")), F.lit("")), plain) if "track_id" in df.columns else plain
    return F.concat(named, F.lit(suffix))


def _objects(df: DataFrame, suffix: str) -> DataFrame:
    if "input_file" not in df.columns:
        raise ValueError("the rows do not carry their input_file")
    named = df.withColumn("__object", object_name(df, suffix)).withColumn("__input", F.coalesce("input_file", F.lit("")))
    body = [c for c in df.columns if c not in ("input_file",)]
    record = as_lines(named.select(*[F.col(f"`{c}`") for c in body], "__object", "__input"), ["__object", "__input"]) if has_rest(df.schema) else named.select(
        "__object", "__input", F.to_json(F.struct(*[F.col(f"`{c}`") for c in body]), {"ignoreNullFields": "false"}).alias("value"))
    df.sparkSession.dataSource.register(PerInputSource)
    return record.hint("rebalance", "__object", "__input").sortWithinPartitions("__object", "__input")


def write_per_input(df: DataFrame, path: str, compression: str | None = None) -> None:
    """JSON lines of each input in an object of its own, named by the input or its ``track_id``; an object that is there is replaced.

    Rows carry their ``input_file``, which is not written. Two inputs of one name fail the job before anything has a name.
    """
    suffix = ".jsonl" + (".gz" if compression == "gzip" else "")
    attempt = uuid.uuid4().hex[:12]
    try:
        _objects(df, suffix).write.format(FORMAT).mode("append").option("path", path).option("attempt", attempt).save()
        system, listed = _opened(_list_of(path, attempt))
        with system.open_input_stream(listed, compression=None) as source:
            pieces = json.loads(source.read())
        folder, whole = os.path.dirname(listed), {}
        several: dict[str, list[tuple[str, int]]] = {}
        for name, group in groupby(pieces, key=lambda piece: piece[0]):
            parts = [(hidden, size) for _, hidden, size in group]
            whole[name] = parts[0][0] if len(parts) == 1 else f"{folder}/{HIDDEN}{attempt}-{uuid.uuid4().hex}"
            if len(parts) > 1:
                several[whole[name]] = parts
        if several:
            _put_together(df.sparkSession, path, several)
        for name, hidden in whole.items():
            system.move(hidden, f"{folder}/{name}")
    finally:
        _clean(path, attempt)


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution inside the block: Spark turns it off in the session of a stream, where a table of one micro-batch may use it."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stream_per_input(df: DataFrame, path: str, checkpoint: str, compression: str | None = None, trigger: dict[str, Any] | None = None) -> StreamingQuery:
    """The same for a stream of files: a file is in one micro-batch, so it becomes one object. Every micro-batch is committed as a whole, and
    one that is run again replaces its own objects."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with _adaptive(batch.sparkSession):
            write_per_input(batch, path, compression)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
