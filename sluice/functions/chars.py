"""Character statistics as row-local operators: nothing is shuffled, whatever the size of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.kernels import char_counts_udf, char_stats_udf


def char_entropy(df: DataFrame, col: str = "text", out: str = "entropy") -> DataFrame:
    """Shannon entropy in bits over the code points of ``col``; 0.0 for the empty text, NULL for NULL."""
    entropy = char_stats_udf(("entropy",))(F.col(col))["entropy"]
    return df.withColumn(out, F.when(F.col(col).isNotNull(), entropy))


def char_freq(df: DataFrame, keys: list[str], col: str = "text") -> DataFrame:
    """One row per record and distinct character: ``keys``, ``ch``, ``n``.

    A text is counted inside its row, so only its distinct characters leave it and no grouping over records is needed.
    """
    counted = df.select(*keys, char_counts_udf()(F.col(col)).alias("__counts"))
    return counted.select(*keys, F.inline("__counts"))
