"""Merging labels back into the rows they were computed from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.plans.registry import operator

RANGES_PER_GROUP = 32


def rank_positions(
    df: DataFrame,
    group: str,
    order_by: str,
    out: str = "row_pos",
    ranges: int = RANGES_PER_GROUP,
) -> DataFrame:
    """0-based position of each row in its group, ordered by a unique number, date or timestamp.

    Every group, whatever its size, is cut into ``ranges`` at approximate quantiles; rows are numbered inside each range and
    shifted by the exact row count of the ranges before it. The cuts only balance the work, the positions are exact.
    """
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = df.groupBy(F.col(group).alias("__group")).agg(
        F.percentile_approx(order_by, cuts, 20 * ranges).alias("__bounds"))
    below = F.size(F.filter("__bounds", lambda b: b < F.col(order_by)))
    ranged = (
        df.join(bounds, F.col(group).eqNullSafe(F.col("__group")), "left")
        .withColumn("__range", F.coalesce(F.when(F.col("__bounds").isNotNull(), below), F.lit(0)))
        .drop("__bounds", "__group")
    )
    before = Window.partitionBy("__g").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(F.col(group).alias("__g"), F.col("__range").alias("__r"))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("__g", "__r", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy(group, "__range").orderBy(order_by)
    numbered = ranged.withColumn("__pos", F.row_number().over(inside) - 1)
    same = F.col(group).eqNullSafe(F.col("__g")) & (F.col("__range") == F.col("__r"))
    return numbered.join(starts, same, "inner").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("__start") + F.col("__pos")).cast("bigint").alias(out)
    )


def combine_label(
    base: DataFrame,
    labelled: DataFrame,
    cols: list[str],
    on: str | list[str] = ("input_file", "row_pos"),
) -> DataFrame:
    """Rows of ``base`` with ``cols`` taken from the matching row of ``labelled``.

    With the default keys this is a positional merge per file that stops at the shorter side; positions come
    from ``read_jsonl(positions=True)``, ``file_positions`` or ``rank_positions``. With another key (such as
    ``track_id``) it is a plain inner join on that key.
    """
    keys = [on] if isinstance(on, str) else list(on)
    missing = [c for c in cols if c not in labelled.columns]
    if missing:
        raise KeyError(f"labelled rows lack {missing}")
    labels = labelled.select(*keys, *[F.col(f"`{c}`").alias(f"__label_{c}") for c in cols])
    joined = base.join(labels, keys, "inner")
    kept = [F.col(f"__label_{c}").alias(c) if c in cols else F.col(f"`{c}`") for c in base.columns]
    added = [F.col(f"__label_{c}").alias(c) for c in cols if c not in base.columns]
    return joined.select(*kept, *added)


@operator("combine_label")
def combine_label_step(
    df: DataFrame,
    base: DataFrame,
    combing_cols: list[str],
    on: str | list[str] = ("input_file", "row_pos"),
) -> DataFrame:
    """Chain form: the incoming rows carry the labels, ``base`` is the original data."""
    return combine_label(base, df, combing_cols, on)
