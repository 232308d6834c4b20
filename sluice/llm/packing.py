"""Harmonic packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.tokens import encoder

_PARTITION_BITS = 33

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
])


def cuts(n: int, capacity: int, waste: float) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: whole sequences first, then pieces that fit a reciprocal class.

    A rest of length r is in class k = capacity // r, and k of its kind share a sequence. If they would leave more than
    ``waste`` of it empty, the piece capacity // (k + 1), which fills its class exactly but for rounding, is cut off first.
    """
    pieces = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if rest * k >= (1 - waste) * capacity or capacity // (k + 1) == 0:
            pieces.append(rest)
            break
        pieces.append(capacity // (k + 1))
        rest -= capacity // (k + 1)
    return pieces


class _Packer:
    """The bins of one worker: for each class one open bin, closed when it holds its fixed number of pieces."""

    def __init__(self, capacity: int, partition: int) -> None:
        self.capacity, self.next_id = capacity, partition << _PARTITION_BITS
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((*piece[:5], self.next_id, offset, *piece[5:]))
            offset += piece[2]
        self.next_id += 1

    def add(self, piece: tuple) -> None:
        k = self.capacity // piece[2]
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            self._close(self.open.pop(k))

    def finish(self) -> None:
        """Merge the unfinished bins, at most one for each class, by first fit on decreasing lengths."""
        left = sorted((p for pieces in self.open.values() for p in pieces), key=lambda p: -p[2])
        bins: list[list[tuple]] = []
        free: list[int] = []
        for piece in left:
            for i, space in enumerate(free):
                if space >= piece[2]:
                    break
            else:
                i = len(free)
                bins.append([])
                free.append(self.capacity)
            bins[i].append(piece)
            free[i] -= piece[2]
        self.open = {}
        for pieces in bins:
            self._close(pieces)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _pack(vocabulary: str, capacity: int, end_id: int, waste: float, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(_schema(with_ids))
        encode = encoder(vocabulary)
        packer = _Packer(capacity, TaskContext.get().partitionId())
        tail = np.array([end_id], "<u4")
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.concatenate([encode(text.as_py() or ""), tail])
                doc_id, start = doc_id.as_py(), 0
                for length in cuts(len(ids), capacity, waste):
                    part = ids[start:start + length]
                    piece = (doc_id, start, length, zlib.crc32(part.tobytes()), len(ids))
                    packer.add((*piece, part.astype("<i4")) if with_ids else piece)
                    start += length
                if len(packer.done) >= (256 if with_ids else 8192):
                    yield _rows(packer.done, schema)
                    packer.done = []
        packer.finish()
        if packer.done:
            yield _rows(packer.done, schema)

    return run


def _schema(with_ids: bool) -> T.StructType:
    extra = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    return T.StructType([*PIECES.fields, *extra])


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 0, waste: float = 0.02,
                   doc_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` ids; one row per piece.

    Each text is encoded (null: empty) and ended by ``end_id``, then cut into pieces (:func:`cuts`). Piece lengths fall into the
    classes (capacity / (k + 1), capacity / k], and a bin of class k takes exactly k pieces, so a worker fills its bins from a
    single pass over its rows without looking at other workers or at free space. Only one open bin per class is kept, however
    many rows a worker has; at the end of its rows the open bins are merged. There is no shuffle.

    ``sequence_id`` is unique over the table (partition and number in it); ``offset`` is gapless from 0 in a sequence. Repeated
    rows and null ids are packed like any others; an empty table gives no pieces; the longest texts are cut, never dropped.
    ``with_ids`` adds the ids of each piece.
    """
    return docs.select(docs[doc_col].cast("long"), docs[text_col]).mapInArrow(
        _pack(vocabulary, capacity, end_id, waste, with_ids), _schema(with_ids))
