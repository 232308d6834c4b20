"""Token-id matrices: best-fit-decreasing packing with a segment tree over free capacities, as binary rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.llm.tokens import encoder

_PARTITION_BITS = 33
CHUNK = 2_000_000  # ids that a worker packs together: what it holds in memory

ROWS = T.StructType([
    T.StructField("sequence_id", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
    T.StructField("position_resets", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.IntegerType()),
    T.StructField("ids", T.BinaryType()), T.StructField("ids_crc32", T.LongType()),
])


class FreeSpace:
    """Open bins by free capacity. A segment tree over the capacities tells which have bins, so that the tightest capacity of at
    least a given length is found in a number of steps that grows with the logarithm of the row width."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, bin_: int, capacity: int) -> None:
        self.bins[capacity].append(bin_)
        self._change(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Bin and capacity of the tightest fit; of equal fits the one that was opened or used last."""
        node = length + self.leaves
        if not self.count[node]:
            while node & 1 or not self.count[node + 1]:  # up to the first right neighbour that has a bin
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1  # then down to its leftmost
        capacity = node - self.leaves
        bin_ = self.bins[capacity].pop()
        self._change(capacity, -1)
        return bin_, capacity


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Bins of piece numbers: the longest piece first, each into the open bin that it fills best."""
    space, bins = FreeSpace(width), []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = space.take(lengths[piece])
        if found is None:
            found = (len(bins), width)
            bins.append([])
        bin_, capacity = found
        bins[bin_].append(piece)
        if capacity > lengths[piece]:
            space.put(bin_, capacity - lengths[piece])
    return bins


def _pack(vocabulary: str, width: int, end_id: int, pad_id: int, id_type: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, encode = to_arrow_schema(ROWS), encoder(vocabulary)
        next_id = TaskContext.get().partitionId() << _PARTITION_BITS
        pieces: list[tuple[int | None, int, np.ndarray]] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            rows = []
            for own in best_fit_decreasing([len(p[2]) for p in pieces], width):
                parts = [pieces[i] for i in own]
                bounds = np.cumsum([0] + [len(p[2]) for p in parts])
                ids = np.full(width, pad_id, id_type)
                ids[:bounds[-1]] = np.concatenate([p[2] for p in parts])
                raw = ids.tobytes()
                rows.append((next_id, [p[0] for p in parts], [p[1] for p in parts], bounds.tolist(), bounds[:-1].tolist(), int(bounds[-1]),
                             raw, zlib.crc32(raw)))
                next_id += 1
                if len(rows) == 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), end_id).astype(id_type)
                pieces += [(doc_id, at, ids[at:at + width]) for at in range(0, len(ids), width)]
                held += len(ids)
                if held >= CHUNK:
                    yield from packed()
                    pieces, held = [], 0
        if pieces:
            yield from packed()

    return run


def token_matrix(docs: DataFrame, vocabulary: str, width: int = 1024, end_id: int = 50256, pad_id: int = 0, id_type: str = "<u2",
                 doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole documents as rows of a token-id matrix with ``width`` columns; one row per sequence.

    Each text is encoded (null: empty) and ended by ``end_id``. A document longer than a row is cut into whole rows and a rest, so
    nothing is lost. A worker packs its documents in chunks of about CHUNK ids (one document, however long, is in one chunk): the
    pieces, longest first, go to the row with the least free space that holds them. There is no shuffle.

    ``ids`` holds ``width`` little-endian numbers of ``id_type``, padded by ``pad_id`` beyond ``n_tokens``. ``cu_seqlens`` are the
    cumulative segment lengths (from 0 to ``n_tokens``), ``position_resets`` the offsets at which positions start again from 0, and
    ``doc_ids`` and ``starts`` name the document of each segment and its first id there. ``ids_crc32`` is of ``ids``.
    ``sequence_id`` is unique over the table. Repeated rows and null ids are packed like any others; an empty table has no rows.
    """
    if np.iinfo(id_type).max < end_id:
        raise ValueError(f"{end_id} does not fit {id_type}; pass a wider id_type")
    return docs.select(docs[doc_col].cast("long"), docs[text_col]).mapInArrow(_pack(vocabulary, width, end_id, pad_id, id_type), ROWS)


def write_token_matrix(matrix: DataFrame, path: str) -> None:
    """Write the rows as Parquet without further encoding of the binary column; readers take rows as fixed-width vectors."""
    matrix.write.option("parquet.enable.dictionary", "false").parquet(path)


def read_token_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(path)


def position_ids(cu_seqlens: list[int], width: int) -> np.ndarray:
    """Positions of a row: they count from 0 in each segment, and in the padding."""
    bounds = np.array([*cu_seqlens, width])
    starts = np.repeat(bounds[:-1], np.diff(bounds))
    return np.arange(width) - starts
