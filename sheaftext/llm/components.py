"""Connected components of an edge table by the smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaftext.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b bigint): root is the smallest node it is connected with.

    Each round takes the least label among neighbours and then the label of that label; rounds grow with the
    logarithm of the longest path, and each is written to the shared folder.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        closer = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        moved = materialise(closer.join(jump, "mid").select("node", "was", F.least("mid", "far").alias("root")), "labels")
        labels = moved.select("node", "root")
        if not moved.where("root <> was").limit(1).count():
            return labels
