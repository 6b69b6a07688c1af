"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk.session import stage


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component) for every id of ``links`` (a, b): the smallest id reachable.

    Each round gives a node the smallest label among its own and its neighbours', then the
    label of that label's node. Stars settle in two rounds, chains in the logarithm of their
    length. Labels are stored after each round; links to a frequent centre are summed
    before they are shuffled.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    edges = stage(both.where("a <> b").distinct(), "links")
    labels = stage(
        edges.groupBy(F.col("a").alias("id")).agg(
            F.least(F.min("b"), F.first("a")).alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.withColumnsRenamed({"id": "b", "component": "_near"}), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("_near").alias("_near"))
        )
        hooked = labels.join(near, "id", "left").select(
            "id",
            F.col("component").alias("_was"),
            F.least("component", "_near").alias("_next"),
        )
        roots = labels.withColumnsRenamed({"id": "_next", "component": "_root"})
        moved = stage(
            hooked.join(roots, "_next", "left").select(
                "id", "_was", F.least("_next", "_root").alias("component")
            ),
            "labels",
        )
        labels = moved.select("id", "component")
        if moved.where("_was <> component").isEmpty():
            return labels
