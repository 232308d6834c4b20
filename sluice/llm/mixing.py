"""Mix sources to target weights by systematic sampling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.runs import before, ordered_runs

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """``(source, source_size)`` to ``target``: weights cycle over the sources by code point, null last; shares add up to all sizes.

    No target is above ``cap`` times its source. What a capped source leaves is shared again by weight. In closed form: with the
    sources in the order of ``cap * size / weight``, the level is the first ``(all - caps of the sources before) / (weights from
    here on)`` that its own source can hold.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (sizes.withColumn("weight", F.get(cycle, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")))
              .withColumn("limit", F.col("source_size") * F.lit(float(cap))))
    holds = F.col("limit") / F.col("weight")
    climb = Window.orderBy("holds", F.col("source").asc_nulls_last())
    before_here = climb.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    filled = (ranked.withColumn("holds", holds)
              .withColumn("full", F.coalesce(F.sum("limit").over(before_here), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before_here), F.lit(0.0)))
              .withColumn("level", (F.sum("source_size").over(whole) - F.col("full")) / F.col("open"))
              .withColumn("step", F.row_number().over(climb)))
    level = F.min_by(F.when(F.col("level") <= F.col("holds"), F.col("level")),
                     F.when(F.col("level") <= F.col("holds"), F.col("step"))).over(whole)
    return (filled.withColumn("level", level)
            .select("source", "source_size", F.least(F.col("limit"), F.col("level") * F.col("weight")).alias("target")))


def _uniform(seed: int, source: Column, draw: Column) -> Column:
    """In (0, 1), by the seed, the source's name and the number of the draw."""
    spread = F.pmod(F.xxhash64(F.lit(seed), source, draw), F.lit(1 << 30))
    return (spread + F.lit(0.5)) / F.lit(float(1 << 30))


def systematic_mix(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 1, draws: int = 32) -> DataFrame:
    """How often the mix takes each row. ``rows`` has ``doc_id``, ``source`` and a long ``size``, and none of the names added.

    Inside a source every row is expected ``target / source_size`` times. Along the source's rows, ordered by size so that small
    and large ones are sampled evenly, these expectations are summed; one random offset per source is added, and a row is taken
    once for each integer that its step crosses. So a row is taken the floor or the ceiling of its expectation. The offset is
    that one of ``draws`` random ones whose mix comes closest to the target.

    Places are prefix sums of row counts over written runs, so a source that holds most rows is spread over many tasks. Adds
    ``source_size``, ``target`` and ``copies``. A null source is a source of its own, sizes of 0 are taken like others, ties in
    size go by ``doc_id``, and an empty table gives an empty result. Reruns on the same rows agree.
    """
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.xxhash64("doc_id"), F.col("doc_id")]
    runs = ordered_runs(rows, order, "mix-runs")
    here = runs.groupBy("run", "source").agg(F.count("*").alias("rows"), F.min("row").alias("first"), F.sum("size").alias("words"))
    sizes = here.groupBy("source").agg(F.sum("words").alias("source_size"))
    # As many rows as runs and sources together.
    starts = here.select("run", "source", "first", before(F.col("rows"), ["source"], ["run"]).alias("ahead"))
    targets = source_targets(sizes, weights, cap).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))

    def match(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
        """Inner join in which null keys meet."""
        other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
        joined = left.join(other, [left[k].eqNullSafe(other[f"__{k}"]) for k in keys])
        return joined.drop(*[f"__{k}" for k in keys])

    def crossed(offset: Column) -> Column:
        step = F.floor((F.col("place") + 1) * F.col("rate") + offset) - F.floor(F.col("place") * F.col("rate") + offset)
        return step.cast("long")

    def placed(table: DataFrame) -> DataFrame:
        return (match(match(table, starts, "run", "source"), targets, "source")
                .withColumn("place", F.col("ahead") + F.col("row") - F.col("first")))

    narrow = placed(runs.select("run", "row", "source", "size"))
    tried = narrow.groupBy("source", "target").agg(
        F.array(*[F.sum(F.col("size") * crossed(_uniform(seed, F.col("source"), F.lit(i)))) for i in range(draws)]).alias("taken"))
    misses = F.transform("taken", lambda taken, i: F.struct(F.abs(taken - F.col("target")).alias("miss"), i.alias("draw")))
    offsets = tried.select("source", F.array_min(misses)["draw"].alias("draw")).select(
        "source", _uniform(seed, F.col("source"), F.col("draw")).alias("offset"))
    return (match(placed(runs), offsets, "source").withColumn("copies", crossed(F.col("offset")))
            .drop("run", "row", "first", "ahead", "rate", "place", "offset"))


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns only. Needs ``doc_id`` and ``source``."""
    rows = docs.select("doc_id", "source", word_count(F.col(text_col)).alias("size"), F.struct("*").alias("doc"))
    taken = systematic_mix(rows, **options).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
