"""Progress and status tables computed from a manifest of produced files.

A manifest has ``run_id, step_id, input_file, output_file, state`` and, where inputs were tried again, ``attempt``; the inputs of
a run have ``run_id, step_id, input_file``. An input may have several output files, several inputs may share one, and an input
that was skipped has no output file. Distinct counts first group by (step, file), so one step that holds a third of all files is
still counted by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.scalar import metadata_path


STATES = ("success", "skipped", "failed")
MANIFEST = "run_id string, step_id string, input_file string, output_file string, state string, attempt int"


def manifest_from_output(output: DataFrame, run_id: str, step_id: str, state: str = "success", attempt: int = 0) -> DataFrame:
    """Manifest rows of a finished step, from a read of its sink that still has ``_metadata``."""
    return output.select(
        F.lit(run_id).alias("run_id"), F.lit(step_id).alias("step_id"), "input_file",
        metadata_path(F.col("_metadata.file_path")).alias("output_file"), F.lit(state).alias("state"),
        F.lit(attempt).alias("attempt"),
    ).distinct()


def _attempt(manifest: DataFrame) -> Column:
    return F.col("attempt") if "attempt" in manifest.columns else F.lit(0)


def merge_manifest(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Union of two manifests with one row per step and output file (per input where there is no output).

    The row of the higher attempt stays, and at the same attempt that of the newer manifest, so a retry that succeeds replaces
    the failure before it. Among equals the smallest remaining values win, so that a rerun gives the same row.
    """
    both = older.withColumn("__age", F.lit(1)).unionByName(newer.withColumn("__age", F.lit(0)))
    columns = older.columns
    keys = [c for c in ("run_id", "step_id", "input_file" if "state" in columns else None, "output_file") if c in columns]
    rest = [c for c in columns if c not in keys]
    order = F.struct((-_attempt(both)).alias("a"), F.col("__age").alias("b"), *rest)
    return both.groupBy(*keys).agg(F.min(order).alias("__rest")).select(
        *[F.col(c) if c in keys else F.col(f"__rest.{c}") for c in columns])


def last_attempts(manifest: DataFrame) -> DataFrame:
    """One row per step and input: the state of its last attempt, failed if any part of that attempt failed."""
    state = F.struct(_attempt(manifest).alias("attempt"), (F.col("state") == "failed").alias("failed"))
    last = F.max(state).alias("last")
    return manifest.filter(F.col("state").isin(*STATES)).groupBy("run_id", "step_id", "input_file").agg(last).select(
        "run_id", "step_id", "input_file", F.col("last.failed").alias("failed"))


def step_progress(manifest: DataFrame) -> DataFrame:
    """Distinct produced files per step."""
    return manifest.groupBy("step_id").agg(F.countDistinct("output_file").alias("progress"))


def step_status(manifest: DataFrame, inputs: DataFrame) -> DataFrame:
    """One row per step: progress (output files), input count, finished inputs and state.

    An input is finished when its last attempt ended, well or not, or when it was skipped; how many files it produced does not
    matter. A step is failed if the last attempt of an input failed, successful once every input is finished (at once if it has
    no input), running with some finished and pending with none.
    """
    keys = ["run_id", "step_id"]
    wanted = inputs.select(*keys, "input_file").distinct()
    ended = last_attempts(manifest)
    both = wanted.withColumn("__in", F.lit(1)).join(ended, [*keys, "input_file"], "full")
    counts = both.groupBy(*keys).agg(
        F.count("__in").alias("input_count"), F.count_if(F.col("__in").isNotNull() & F.col("failed").isNotNull()).alias("finished"),
        F.coalesce(F.bool_or("failed"), F.lit(False)).alias("any_failed"))
    produced = manifest.groupBy(*keys).agg(F.countDistinct("output_file").alias("progress"))
    state = (
        F.when(F.col("any_failed"), "failed")
        .when(F.col("finished") >= F.col("input_count"), "success")
        .when(F.col("finished") > 0, "running")
        .otherwise("pending")
    )
    return counts.join(produced, keys, "left").select(
        *keys, "input_count", "finished", F.coalesce("progress", F.lit(0)).cast("bigint").alias("progress"), state.alias("state"))


def step_complete(manifest: DataFrame, inputs: DataFrame) -> DataFrame:
    """Whether all inputs of each step are finished."""
    return step_status(manifest, inputs).select(
        "step_id", "input_count", "finished", "progress", (F.col("finished") >= F.col("input_count")).alias("complete")
    )


def run_status(manifest: DataFrame, inputs: DataFrame) -> DataFrame:
    """State of each run: failed if a step failed, success if all succeeded, else running."""
    steps = step_status(manifest, inputs)
    return steps.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("steps"),
        F.sum("progress").alias("progress"),
        F.sum("input_count").alias("input_count"),
        F.sum("finished").alias("finished"),
        F.when(F.bool_or(F.col("state") == "failed"), "failed")
        .when(F.bool_and(F.col("state") == "success"), "success")
        .otherwise("running")
        .alias("state"),
    )
