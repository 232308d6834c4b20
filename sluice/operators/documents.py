"""Extraction of content blocks from binary documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.functions.blocks import CONTENT_LIST_SCHEMA
from sluice.operators.rows import ERROR_FIELDS
from sluice.plans.registry import operator

Extractor = Callable[[bytes], list[dict]]


def fetch_bytes(path: str) -> bytes:
    """Read one object by path or URI."""
    if "://" not in path:
        path = path.removeprefix("file:")
        with open(path, "rb") as handle:
            return handle.read()
    system, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    with system.open_input_stream(name) as stream:
        return stream.read()


@operator("extract_documents", kind="gpu_model")
def extract_documents(
    df: DataFrame,
    extractor: Extractor,
    bytes_col: str | None = "content",
    path_col: str | None = None,
    fetch: Callable[[str], bytes] = fetch_bytes,
    partitions: int | None = None,
    profile: Any = None,
) -> DataFrame:
    """Add ``content_list`` (array of type/md/text blocks) and the error columns to each document.

    Bytes come from ``bytes_col`` or, when ``path_col`` is given, are fetched inside the task, one document at a
    time. A document that cannot be read keeps its row with ``_error = "read_error"``; one that the extractor
    refuses gets ``"extract_error"``. A short list of paths usually sits in one input partition, so set
    ``partitions`` to spread the work. ``profile`` is a ResourceProfile, for instance for GPU nodes.
    """
    carried = [f for f in df.schema.fields if path_col or f.name != bytes_col]
    block_type = T.StructType.fromDDL(f"content_list {CONTENT_LIST_SCHEMA}").fields
    replaced = {f.name for f in block_type + ERROR_FIELDS}
    carried = [f for f in carried if f.name not in replaced]
    out = T.StructType(carried + block_type + ERROR_FIELDS)
    arrow, names = to_arrow_schema(out), [f.name for f in carried]

    def blocks_of(raw: bytes | None) -> dict:
        if raw is None:
            return {"_error": "read_error", "_error_msg": "no bytes"}
        try:
            found = [{k: b.get(k) for k in ("type", "md", "text")} for b in extractor(raw)]
        except Exception as error:  # user code may raise anything
            return {"_error": "extract_error", "_error_msg": str(error)}
        return {"content_list": found}

    def extract(source: dict) -> dict:
        if not path_col:
            return blocks_of(source[bytes_col])
        try:
            raw = fetch(source[path_col])
        except Exception as error:  # any storage error becomes an error column
            return {"_error": "read_error", "_error_msg": str(error)}
        return blocks_of(raw)

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                sources = batch.slice(start, 64).to_pylist()
                rows = [{**{k: s[k] for k in names}, **extract(s)} for s in sources]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    if partitions:
        df = df.repartition(partitions)
    return df.mapInArrow(process, out, profile=profile)
