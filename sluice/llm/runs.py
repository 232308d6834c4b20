"""Rows in a global order, numbered by partition: the base of distributed prefix sums."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the lower 33 bits


def ordered_runs(df: DataFrame, order: list[Column], label: str, then: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """``df`` in global order as written runs: adds ``run`` (one per range partition, ascending) and ``row`` (0, 1, ... inside it).

    Rows are dealt out by range, with the place of a row in the input as last key, so that a third of all rows with equal keys
    still spreads over many runs. The result is written to the shared folder: range bounds come from a sample that differs from
    one execution to the next, and whoever reads twice must see the same runs. ``then`` may add columns that need a run's rows
    together and in order, which holds only before the files are split for reading.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    keys = [*order, F.col("__place")]
    at = F.col("__at")
    ranged = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__place")
    numbered = ranged.withColumn("__at", F.monotonically_increasing_id())
    runs = then(numbered.withColumn("run", F.shiftright(at, _ROW_BITS).cast("int"))
                .withColumn("row", at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).drop("__at"))
    runs.write.parquet(path)
    return spark.read.schema(runs.schema).parquet(path)


def before(value: Column, keys: list[str], order: list[str]) -> Column:
    """Sum of ``value`` over the rows before this one, for summary tables with a row per run."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))
