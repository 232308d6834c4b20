"""Tables of a fixed size, counted over all partitions: they reach the driver and the executors whole, whatever the input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCKS = 16
SCHEMA = "block int, cells binary"
ARROW = pa.schema([("block", pa.int32()), ("cells", pa.binary())])


def blocks_of(table: np.ndarray) -> list[tuple[int, bytes]]:
    """The table in BLOCKS pieces; pieces without a count are left out."""
    return [(i, part.tobytes()) for i, part in enumerate(np.split(table, BLOCKS)) if part.any()]


def merged(blocks: DataFrame, dtype: str, size: int, combine: str) -> np.ndarray:
    """Combine the partial tables by ``add`` (saturating) or ``or``.

    Each of the BLOCKS pieces is combined by one task that streams over the partials and holds one piece per block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(cells.as_buffer(), dtype)
                if block not in held:
                    held[block] = part.copy()
                elif combine == "or":
                    held[block] |= part
                else:
                    total = held[block] + part
                    held[block] = np.where(total < part, np.iinfo(dtype).max, total).astype(dtype)
        if held:
            yield pa.RecordBatch.from_pydict({"block": list(held), "cells": [t.tobytes() for t in held.values()]}, schema=ARROW)

    table = np.zeros(size, dtype)
    width = size // BLOCKS
    for row in blocks.select("block", "cells").repartition(BLOCKS, "block").mapInArrow(run, SCHEMA).collect():
        table[row["block"] * width:(row["block"] + 1) * width] = np.frombuffer(row["cells"], dtype)
    return table
