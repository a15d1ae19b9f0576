"""Connected components of a graph given as links, by repeated joins of written tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom import scratch
from tapeloom.operators.joins import join_lookup


def components(links: DataFrame, most: int = 100) -> DataFrame:
    """node, label: for each end of a link (``a``, ``b``) the smallest node that links lead to.

    Each round every node takes the smallest label next to it, and then that label's own label, so the
    rounds grow with the logarithm of a chain's length. Minima are taken in each task before the shuffle. A round
    writes two tables, measured as they are written, so that the joins to them need no copy of their own.
    """

    def measured(table: DataFrame) -> tuple[DataFrame, scratch.Size]:
        """A written table of labels, one row for each node, and the size of two of its columns."""
        kept, size, _ = scratch.keep_measured(table, "labels", ["node"])
        return kept, replace(size, bytes=size.bytes // len(table.columns) * 2)

    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = scratch.keep(ends.distinct(), "ends")
    labels = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels, size = measured(labels.select("node", F.least("node", "label").alias("label")))
    for _ in range(most):
        seen = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = join_lookup(ends, seen, "b", "inner", size=size, unique=True)
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        least = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        least, size = measured(least)
        above = least.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = join_lookup(least, above, "label", "inner", size=size, unique=True)
        moved, size = measured(jumped.select("node", "old", F.least("label", "above").alias("label")))
        labels = moved.select("node", "label")
        if moved.where(F.col("label") != F.col("old")).isEmpty():
            return labels
    raise RuntimeError("the components did not settle")
