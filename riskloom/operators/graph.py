"""Components and roots of links between issuers, lines, clones and dual listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.session import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of ``edges``; root is the smallest node it is connected with.

    Each round a node takes the smallest root among its neighbours', hands it on to its old root, and then
    takes the root of its root, so rounds grow with the logarithm of a component's width. Every step is an
    aggregation with map-side combine or a join; labels are written between rounds. Loops and repeated links
    do no harm, a link to null names only the other node.
    """
    x, y = F.col(a).alias("x"), F.col(b).alias("y")
    both = stored(edges.select(x, y).union(edges.select(F.col(b), F.col(a))).where("x is not null").withColumn("y", F.coalesce("y", "x")).distinct())
    labels = stored(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low")).select("node", F.least("node", "low").alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("root").alias("near"))
        met = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        hooked = met.select(F.col("root").alias("node"), "low").union(met.select("node", "low")).groupBy("node").agg(F.min("low").alias("low"))
        up = hooked.select(F.col("node").alias("low"), F.col("low").alias("top"))
        step = hooked.join(up, "low", "left").select("node", F.least("low", F.coalesce("top", "low")).alias("root"))
        new = stored(labels.withColumnRenamed("root", "was").join(step, "node"))
        labels = new.select("node", "root")
        if new.where("was <> root").isEmpty():
            return labels


def roots(pointers: DataFrame, child: str, parent: str) -> DataFrame:
    """(child, root): where each child's pointers end; null on a circle. A child has one parent.

    Pointers are followed in doubling steps until each ends at something that points nowhere. Those that
    have not ended after more steps than there are children are on a circle, or lead to one.
    """
    p = stored(pointers.select(F.col(child).alias("child"), F.col(parent).alias("root")).where("child is not null and root is not null"))
    reach, children = 1, p.count()
    while True:
        ahead = p.select(F.col("child").alias("root"), F.col("root").alias("further"))
        open_ = p.join(ahead.select("root"), "root", "left_semi")
        if open_.isEmpty():
            return p.select(F.col("child").alias(child), "root")
        if reach > children:
            ended = p.join(ahead.select("root"), "root", "left_anti").select("child", "root")
            return p.select("child").join(ended, "child", "left").select(F.col("child").alias(child), "root")
        p = stored(p.join(ahead, "root", "left").select("child", F.coalesce("further", "root").alias("root")))
        reach *= 2
