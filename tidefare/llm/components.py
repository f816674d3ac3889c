"""Connected components of a graph given by links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefare.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link (a, b); the component is its smallest node.

    Every round a node takes the smallest label among its neighbours' and its own, then the label of
    that label. Rounds go on until none changes; their number follows the logarithm of the longest
    path. Labels are stored after each round. No links give no rows.
    """
    both = stored(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .where(F.col("node") != F.col("other")).distinct(),
        "component-links",
    )
    labels = stored(both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("label")), "component-labels")
    while True:
        known = labels.select(F.col("node").alias("other"), F.col("label").alias("others_label"))
        nearest = both.join(known, "other").groupBy("node").agg(F.min("others_label").alias("nearest"))
        lowered = labels.join(nearest, "node").select("node", "label", F.least("label", "nearest").alias("lower"))
        jumps = labels.select(F.col("node").alias("lower"), F.col("label").alias("jump"))
        renewed = stored(
            lowered.join(jumps, "lower").select("node", F.least("lower", "jump").alias("label"), (F.least("lower", "jump") != F.col("label")).alias("changed")),
            "component-labels",
        )
        if renewed.where("changed").isEmpty():
            return renewed.select("node", F.col("label").alias("component"))
        labels = renewed.select("node", "label")
