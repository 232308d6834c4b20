"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.runs import before, ordered_runs


def byte_size(text: Column) -> Column:
    """UTF-8 bytes plus one for the separator; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``ahead``: the sizes of earlier rows of the partition. Holds one batch and one number."""
    import pyarrow.compute as pc

    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sums = pc.add(pc.cumulative_sum(batch.column("size")), total)
        yield pa.RecordBatch.from_arrays([*batch.columns, pc.subtract(sums, batch.column("size"))],
                                         names=[*batch.schema.names, "ahead"])
        total = sums[-1].as_py()


def balanced_shards(rows: DataFrame, n_shards: int, order: list[Column]) -> DataFrame:
    """Give each row a shard and a place in it. ``rows`` has a long column ``size``, at least 1, and none of the names added.

    The rows are put in the global order ``order`` and numbered by range partition. Each partition reports its bytes and rows;
    prefix sums over these few totals give every partition its place in the corpus, and a row's shard is the one of the
    ``n_shards`` equal byte targets in which the middle of the row falls. Shards are contiguous in the order and differ from
    the target by less than the largest row. Adds ``shard`` (0 to n_shards - 1) and ``slot`` (0, 1, ... inside a shard).

    Ties keep their input order. Repeated rows are separate rows. An empty table gives an empty result. Rows larger than a
    target leave shards empty, as no row is cut.
    """
    runs = ordered_runs(rows, order, "shard-runs", lambda numbered: numbered.mapInArrow(
        _running, T.StructType([*numbered.schema.fields, T.StructField("ahead", T.LongType())])))
    # One row per range partition, at most spark.sql.shuffle.partitions rows: small enough for one window and a broadcast.
    totals = runs.groupBy("run").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    offsets = totals.select("run", before(F.col("bytes"), [], ["run"]).alias("bytes_before"),
                            before(F.col("rows"), [], ["run"]).alias("rows_before"))
    corpus = totals.agg(F.sum("bytes").alias("corpus_bytes"))
    middle = "2 * (bytes_before + ahead) + size"
    placed = (runs.join(F.broadcast(offsets), "run").join(F.broadcast(corpus))
              .withColumn("shard", F.expr(f"cast(({middle}) * {n_shards} div (2 * corpus_bytes) as int)"))
              .withColumn("place", F.col("rows_before") + F.col("row")))
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # n_shards rows
    return (placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("place") - F.col("first"))
            .drop("run", "row", "ahead", "bytes_before", "rows_before", "corpus_bytes", "place", "first"))


def write_shards(docs: DataFrame, path: str, n_shards: int, order: list[Column], text_col: str = "text") -> None:
    """Write whole documents as one folder per shard, in slot order inside each file; documents are carried as a struct."""
    rows = docs.select(byte_size(F.col(text_col)).alias("size"), F.struct("*").alias("doc"))
    placed = balanced_shards(rows, n_shards, order)
    (placed.select("shard", "slot", "doc.*").repartitionByRange(F.col("shard"), F.col("slot"))
        .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
