"""Files read by reference inside tasks: the references stay a table, whatever their number.

A task opens the files that its rows name with the file systems of pyarrow (local, ``s3``/``s3a``, ``gs``, ``hdfs``, ``abfss``), in their
environment's credentials. Files in other stores are read by Spark's own readers from a folder above them
(:func:`sluice.sources.files.read_by_index` with ``root``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 20  # bytes read at a time
_systems: dict[str, fs.FileSystem] = {}


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, kept per store by each worker, and the path in it."""
    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + re.sub("^file:", "", path).lstrip("/")
    scheme, _, rest = path.partition("://")
    store, _, inner = rest.partition("/")
    key = f"{scheme}://{store}"
    if key not in _systems:
        uri = re.sub("^s3[an]:", "s3:", key)
        _systems[key] = fs.FileSystem.from_uri(uri if scheme.startswith("s3") or scheme == "gs" else uri + "/")[0]
    return _systems[key], f"{store}/{inner}" if scheme.startswith("s3") or scheme == "gs" else "/" + inner


def file_exists(path: str) -> bool:
    system, inner = _opened(path)
    return system.get_file_info(inner).type == fs.FileType.File


def _lines(path: str) -> Iterator[list[bytes]]:
    """Lines of a text file, block by block; ``.gz`` is unpacked. Lines end as Spark's text reader ends them."""
    system, inner = _opened(path)
    with system.open_input_stream(inner, compression="gzip" if inner.endswith(".gz") else None) as stream:
        kept = b""
        while block := stream.read(BLOCK):
            block = kept + block
            if block.endswith(b"\r"):  # the line feed may follow
                cut = max(block.rfind(b"\n"), block.rfind(b"\r", 0, len(block) - 1)) + 1
            else:
                cut = max(block.rfind(b"\n"), block.rfind(b"\r")) + 1
            kept = block[cut:]
            if cut:
                yield block[:cut].splitlines()
        if kept:
            yield kept.splitlines()


def _dealt(refs: DataFrame) -> DataFrame:
    """References over as many tasks as run side by side; small shuffles are not put together again."""
    return refs.repartition(2 * refs.sparkSession.sparkContext.defaultParallelism)


def with_existence(refs: DataFrame, path_col: str = "input_file") -> DataFrame:
    """References with ``exists``, tested by the tasks that hold them."""
    at = refs.columns.index(path_col)
    schema = refs.schema.add("exists", "boolean")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [p is not None and file_exists(p) for p in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.bool_())], names=[*batch.schema.names, "exists"])

    return _dealt(refs).mapInArrow(test, schema)


def lines_of(refs: DataFrame, file_col: str, track_col: str, on_missing: str = "skip") -> DataFrame:
    """``value``, the path and the track of each line of the files that references name.

    A file that does not exist is passed over (``skip``), fails the job (``fail``) or gives one row without a value (``report``).
    """
    if on_missing not in ("skip", "fail", "report"):
        raise ValueError(f"on_missing is skip, fail or report, not {on_missing!r}")
    names = ["value", file_col, track_col]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, track in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if on_missing != "fail" and not file_exists(path):
                    if on_missing == "report":
                        yield pa.RecordBatch.from_pydict({"value": pa.array([None], pa.string()), file_col: [path], track_col: pa.array([track], pa.string())})
                    continue
                for lines in _lines(path):
                    text = pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())
                    yield pa.RecordBatch.from_arrays([text, pa.array([path] * len(text), pa.string()), pa.array([track] * len(text), pa.string())], names=names)

    rows = _dealt(refs.select(file_col, track_col))
    return rows.mapInArrow(read, f"value string, `{file_col}` string, `{track_col}` string")
