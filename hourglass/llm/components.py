"""Connected components of a link table, as rounds of joins.

Each node points to a node of its component, at first itself.  A round hooks
each node, and what it points to, to the smallest grandparent among its
neighbours, and halves its own path.  Rounds end when nothing changes; then
each node points to the smallest node of its component.  Every round is
written to the shared scratch folder, so a lost executor costs one round at
most, and nothing but one count per round reaches the driver.  Minima are
pre-aggregated before the shuffle, and the joins have one row per node on one
side, so a node with very many links does not meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import saved


def connect(links: DataFrame) -> DataFrame:
    """``links`` has columns a and b; returns (node, root) of all nodes in links."""
    edges = saved(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "edges")
    points = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root"))
    points = saved(points, "points")
    while True:
        up = points.select(F.col("node").alias("root"), F.col("root").alias("top"))
        tops = saved(points.join(up, "root"), "tops")  # node, root, top
        near = (edges.join(tops.select(F.col("node").alias("b"), "top"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("top").alias("least")))
        met = tops.join(near, "node").select("node", "root", F.least("top", "least").alias("least"))
        hooks = met.select("node", "least", F.col("root").alias("was")).union(
            met.select(F.col("root").alias("node"), "least", F.lit(None).cast("long").alias("was")))
        after = hooks.groupBy("node").agg(F.min("least").alias("root"), F.max("was").alias("was"))
        after = saved(after.select("node", F.least("root", "was").alias("root"), "was"), "points")
        points = after.select("node", "root")
        if after.where(F.col("root") != F.col("was")).isEmpty():
            return points
