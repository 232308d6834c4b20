"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import materialize


def connected(links: DataFrame, label: str) -> DataFrame:
    """``links`` (a, b) to (node, root): the smallest node of each component, for all nodes that have a link.

    Every round a node takes the smallest root among its own and its neighbours', then the root of that root, so paths shorten
    by half. Rounds end when nothing changes. Each round is written to the shared folder: executors may be lost, and the lineage
    does not grow. Nothing is collected but the number of changes.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = materialize(both.distinct(), f"{label}-links")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), f"{label}-roots")
    while True:
        near = (both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        pulled = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        jump = roots.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        moved = pulled.join(jump, "next", "left").select(
            "node", F.least("next", F.coalesce("beyond", "next")).alias("next"), (F.col("root")).alias("before"))
        moved = materialize(moved, f"{label}-roots")
        roots = moved.select("node", F.col("next").alias("root"))
        if not moved.where("next <> before").count():  # one pass; a search for a first row is a job per few partitions where there is none
            return roots
