"""Connected components of an undirected graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitalgrid.session import stored


def components(links: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) for every end of a link (a, b).

    Each round a node takes the smallest root among its neighbours', then its root's root, so that paths halve; labels
    are written once a round. Grouping is pre-aggregated, and joins on a hub's key can be split by Spark.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")),
                    "roots")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
                .join(labels, F.col("a") == F.col("node"))
                .select("node", F.col("root").alias("old"), F.least("root", "near").alias("via")))
        jump = labels.select(F.col("node").alias("j_node"), F.col("root").alias("j_root"))
        moved = stored(near.join(jump, F.col("via") == F.col("j_node"))
                       .select("node", "old", F.least("via", "j_root").alias("root")), "roots")
        labels = moved.select("node", "root")
        if moved.filter(F.col("old") != F.col("root")).isEmpty():
            return labels
