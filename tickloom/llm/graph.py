"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node that links reach.

    Each round takes the smallest label of the neighbours, then the label of that label, so the
    rounds grow with the logarithm of a component's width. Minima combine before the shuffle, so a
    node with very many links is no burden. Every round ends in a stored table.
    """
    both = stored(
        links.select("a", "b").union(links.select("b", "a")).filter("a != b").distinct(), "links"
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")).select("node", "label"), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        pulled = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("new")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        moved = stored(
            pulled.join(jump, pulled["new"] == jump["via"], "left").select(
                "node", "old", F.least("new", "far").alias("label")
            ),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.filter("old != label").isEmpty():
            return labels
