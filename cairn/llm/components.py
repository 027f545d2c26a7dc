"""Connected components of an edge table by distributed minimum labels.

Each round passes the smallest label over every edge and then replaces a label by its
own label (pointer jumping), so the number of rounds grows with the logarithm of the
longest path.  Every round ends in a written table; only a count of changes reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root) for every node of an edge; root is the smallest
    node of its component."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
                         .select("node", F.least("node", "_m").alias("root")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("_near")))
        passed = materialize(labels.join(near, "node").select("node", "root", F.least("root", "_near").alias("_new")))
        up = materialize(passed.select(F.col("node").alias("_new"), F.col("_new").alias("_up")))
        # many nodes share a label: both sides are written tables, so a hot label can be split
        nxt = materialize(passed.join(up, "_new").select("node", "root", F.least("_new", "_up").alias("_new")))
        changed = nxt.where("root <> _new").limit(1).count()
        labels = nxt.select("node", F.col("_new").alias("root"))
        if not changed:
            return labels
