"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.session import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of ``a``-``b``.

    Each round gives a node the smallest label among its neighbours and itself, and then the label
    of that label, so labels travel in leaps; rounds end when no label changes. Labels and edges
    are stored tables, so that adaptive execution can split a node with very many edges.
    """
    own = edges.select("a", "b").where("a <> b")
    both = own.unionByName(own.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "edges")
    label = F.least(F.min("b"), F.col("node")).alias("label")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(label), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b")
        near = seen.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        near = stored(near, "nearest")
        closer = stored(
            labels.join(near, "node").select(
                "node", F.col("label").alias("_was"), F.least("label", "_near").alias("label")
            ),
            "labels",
        )
        leap = closer.select(F.col("node").alias("label"), F.col("label").alias("_leap"))
        after = stored(
            closer.join(leap, "label").select(
                "node", "_was", F.least("label", "_leap").alias("label")
            ),
            "labels",
        )
        done = after.where("label <> _was").isEmpty()
        discard(labels, near, closer, *[both] * done)
        labels = after
        if done:
            return labels.select("node", F.col("label").alias("component"))
