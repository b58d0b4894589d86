"""Connected components: within a task in numpy, across the corpus in Spark."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketlens.llm.common import spread_join
from bucketlens.session import staged


def local_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 to n - 1 and edges a-b, the smallest node each one reaches."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while not np.array_equal(label, label[label]):
            label = label[label]


def _all_stars(edges: DataFrame) -> bool:
    """Is every larger end ``u`` hung on one ``v`` only, and no ``v`` hung on anything?

    Edges then join each node to the smallest one of its component.
    """
    upper = edges.select(F.col("u").alias("node"), F.lit(1).alias("hung"), F.lit(0).alias("holds"))
    lower = edges.select(F.col("v").alias("node"), F.lit(0).alias("hung"), F.lit(1).alias("holds"))
    nodes = upper.unionByName(lower).groupBy("node").agg(F.sum("hung").alias("hung"), F.max("holds").alias("holds"))
    return nodes.where("hung > 1 OR (hung = 1 AND holds = 1)").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node it reaches) for all nodes of ``edges`` (a, b).

    Alternates two steps until every component is a star: a node's larger neighbours
    are hung on its smallest neighbour, then its smaller ones and itself. A hub's edges
    are spread over tasks, minima are combined before the shuffle, and each round is
    written to the shared folder.
    """
    current = staged(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "component-edges"
    )
    while not _all_stars(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = spread_join(both, lowest, ["u"], ["v"], copies=4).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(hung.where("u != v").distinct(), "component-large")

        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = spread_join(large, lowest, ["u"], ["v"], copies=4).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(lowest.withColumnRenamed("m", "v")).where("u != v").distinct()
        current = staged(small, "component-small")
    roots = current.select("v").distinct().select("v", F.col("v").alias("root"))
    return current.toDF("node", "root").unionByName(roots.toDF("node", "root"))
