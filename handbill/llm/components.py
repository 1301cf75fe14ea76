"""Connected components over edges of any number, with nothing gathered on the driver but a count per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) gives (node, label): the smallest node that each node reaches.

    Each step takes the least label of all neighbours (a partial aggregate, so a node with many edges is no
    burden), then the label's own label, which halves the length of chains. Every step is a table in the shared folder."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b"), "cc-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "cc-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("to"), "label")
        hook = near.join(labels.select(F.col("node").alias("to"), F.col("label").alias("old")), "to").select(F.col("old").alias("to"), "label")  # a label's node learns what its members see
        least = near.unionByName(hook).groupBy("to").agg(F.min("label").alias("seen"))
        step = labels.join(least, F.col("node") == F.col("to"), "left").select("node", F.least("label", F.coalesce("seen", "label")).alias("label"), F.col("label").alias("was"))
        step = stored(step, "cc-step")
        jump = step.select(F.col("node").alias("via"), F.col("label").alias("further"))
        new = stored(step.join(jump, F.col("label") == F.col("via"), "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "was"), "cc-labels")
        done = new.where("label <> was").isEmpty()
        discard(labels, step)
        labels = new.drop("was")
        labels._stored_at = new._stored_at
        if done:
            discard(both)
            return labels
