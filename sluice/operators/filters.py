"""Row filters and exact deduplication."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.blocks import content_of
from sluice.functions.scalar import safe_div
from sluice.plans.registry import operator


def text_column(df: DataFrame, col: str | None = None) -> Column:
    """The text that filters look at: ``col``, else ``text``, else the joined content of ``content_list``."""
    if col or "text" in df.columns or "content_list" not in df.columns:
        return F.col(f"`{col or 'text'}`")
    return content_of(df, "content_list")


def key_columns(df: DataFrame, order_by: str | list[str] | None, col: str | None = None) -> list[str]:
    """What orders copies: the given columns, else the first id column there is, else all columns but the text itself."""
    if order_by:
        return [order_by] if isinstance(order_by, str) else list(order_by)
    return [c for c in ("doc_id", "track_id", "id") if c in df.columns][:1] or [c for c in df.columns if c != (col or "text")] or df.columns


@operator("length_filter")
def length_filter(df: DataFrame, col: str | None = None, min_length: int = 100) -> DataFrame:
    """Keep texts of at least ``min_length`` characters."""
    return df.filter(F.length(text_column(df, col)) >= min_length)


@operator("space_ratio")
def space_ratio(df: DataFrame, col: str | None = None, max_ratio: float = 0.1) -> DataFrame:
    """Keep texts whose share of blanks is at most ``max_ratio``; the empty text (NaN) is dropped."""
    text = text_column(df, col)
    n = F.length(text)
    blanks = n - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return df.filter(safe_div(blanks, n) <= max_ratio)


@operator("require")
def require(df: DataFrame, condition: str, message: str = "a record does not meet the condition") -> DataFrame:
    """All records must meet a SQL condition, or the step fails; null does not meet it."""
    met = F.when(F.expr(condition), True).otherwise(F.raise_error(F.concat(F.lit(f"{message}: "), F.lit(condition))).cast("boolean"))
    return df.filter(met)


REMEMBERED = 1_000_000


@F.arrow_udf(T.BooleanType())
def _first_seen(digests: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Whether a digest is new to the task. What is forgotten beyond REMEMBERED digests, the state store still knows."""
    seen: set[str | None] = set()
    for batch in digests:
        fresh = []
        for digest in batch.to_pylist():
            fresh.append(digest not in seen)
            seen.add(digest)
        if len(seen) > REMEMBERED:
            seen.clear()
        yield pa.array(fresh, pa.bool_())


@operator("md5_dedup_within")
def md5_dedup_within(df: DataFrame, within: str, col: str | None = None, time_col: str | None = None) -> DataFrame:
    """One row per distinct ``md5(col)`` among rows that arrive within ``within`` (an interval such as ``"1 day"``) of the first; for streams.

    The state holds the digests of that time and no more: they expire as the watermark passes, and none before ``within`` has passed.
    A later copy is a new text. Time is that of the micro-batch in which a row arrives, so no row is late, or the column ``time_col``, whose
    rows must then come in order up to ``within``.
    """
    if not df.isStreaming:
        raise ValueError("md5_dedup_within is for streams; a table is deduplicated as a whole by md5_dedup")
    digest = F.md5(text_column(df, col).cast("binary"))
    timed = df.withColumn("__at", F.col(time_col) if time_col else F.current_timestamp()).withWatermark("__at", within)
    tagged = timed.withColumn("__md5", digest).withColumn("__first", _first_seen(F.col("__md5")))
    return tagged.filter("__first").dropDuplicatesWithinWatermark(["__md5"]).drop("__md5", "__first", "__at")


@operator("md5_dedup")
def md5_dedup(df: DataFrame, col: str | None = None, order_by: str | list[str] | None = None) -> DataFrame:
    """One row per distinct ``md5(col)``; NULL counts as one text.

    Batch: the survivor is the row with the smallest ``order_by``, null first. The smallest key per digest is aggregated on the map
    side over digests and keys alone, so a text that makes up a third of the corpus sends one narrow row per input partition; rows then
    meet the survivors by digest and key, which spreads the copies of a text over all tasks. Of rows that are equal in both, one stays.

    Streaming: the first row seen survives. Each input partition drops its own copies before the shuffle, so that a
    hot text is again one row per partition, and the state store drops the rest. Without an event time the state holds
    every md5 for the life of the stream; keep it in the RocksDB state store.
    """
    digest = F.md5(text_column(df, col).cast("binary"))
    if df.isStreaming:
        tagged = df.withColumn("__md5", digest).withColumn("__first", _first_seen(F.col("__md5")))
        return tagged.filter("__first").dropDuplicates(["__md5"]).drop("__md5", "__first")
    keys = [F.col(f"`{k}`") for k in key_columns(df, order_by, col)]
    tagged = df.select("*", digest.alias("__md5"), *[k.alias(f"__key{i}") for i, k in enumerate(keys)])
    own = [f"__key{i}" for i in range(len(keys))]
    if len(own) == 1:  # a number stays in the buffer of a hash aggregate
        least = F.when(F.bool_or(F.col(own[0]).isNull()), None).otherwise(F.min(own[0])).alias("__first0")
        first = tagged.groupBy("__md5").agg(least)
    else:
        whole = tagged.groupBy("__md5").agg(F.min(F.struct(*own)).alias("__first"))
        first = whole.select("__md5", *[F.col(f"__first.{k}").alias(f"__first{i}") for i, k in enumerate(own)])
    first = first.withColumnRenamed("__md5", "__digest")
    same = F.col("__md5").eqNullSafe(F.col("__digest"))
    for i, k in enumerate(own):
        same &= F.col(k).eqNullSafe(F.col(f"__first{i}"))
    alike = Window.partitionBy("__md5", *own).orderBy("__md5")
    survivors = tagged.join(first, same, "left_semi").withColumn("__nth", F.row_number().over(alike))
    return survivors.filter("__nth = 1").drop("__md5", "__nth", *own)
