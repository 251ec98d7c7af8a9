"""Connected components of a table of links, by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for every id in ``links``; label: the smallest id reachable.

    Each round takes the smallest label of all neighbours and then that label's label, so that
    the rounds grow with the logarithm of the longest path; the rounds' tables are written, not kept.
    """
    both = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = materialize(both.union(both.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = materialize(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("m"))
        near = materialize(near, "near")
        step = labels.join(near, labels["id"] == near["a"]).select("id", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        step = materialize(step, "step")
        if not step.where("label <> old").limit(1).count():
            return labels
        over = step.select(F.col("id").alias("j"), F.col("label").alias("next"))
        labels = materialize(step.join(over, F.col("label") == F.col("j")).select("id", F.col("next").alias("label")), "labels")
