"""Connected components of an edge table, with rounds of min-label joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.session import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, component) for every vertex of ``edges``; the component is the smallest vertex reachable.

    Each round takes the smallest label among the neighbours and then the
    label of that label, so the rounds grow with the logarithm of the longest
    path rather than with the path. Labels and edges are written in each
    round; nothing is collected but the number of labels that still change.
    """
    both = edges.select(F.col(a).alias("v"), F.col(b).alias("u")).unionAll(
        edges.select(F.col(b).alias("v"), F.col(a).alias("u"))
    )
    both = materialise(both.distinct(), "component-edges")
    labels = both.groupBy("v").agg(F.min("u").alias("component")).withColumn("component", F.least("v", "component"))
    labels = materialise(labels, "component-labels")
    while True:
        known = labels.select(F.col("v").alias("u"), F.col("component").alias("other"))
        near = both.join(known, "u").groupBy("v").agg(F.min("other").alias("nearest"))
        better = labels.join(near, "v").select(
            "v", F.col("component").alias("before"), F.least("component", "nearest").alias("component")
        )
        jump = labels.select(F.col("v").alias("component"), F.col("component").alias("further"))
        after = better.join(jump, "component", "left").select(
            "v", "before", F.least("component", F.coalesce("further", "component")).alias("component")
        )
        after = materialise(after, "component-labels")
        labels = after.select("v", "component")
        if after.where(F.col("before") != F.col("component")).isEmpty():
            return labels
