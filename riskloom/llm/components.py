"""Connected components of links by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node of links (a, b); root is the smallest node of its component.

    In each round every node hooks onto its smallest neighbour, if that is smaller, and labels are followed to
    the trees' tops; then the links are those between trees. A node that is a tree of its own hooks in the next
    round, so every two rounds at least halve the trees, and rounds and the links of all rounds stay few. Labels
    and links are written under the shared folder between rounds; all steps are joins and aggregations with
    map-side combine, so a hub of any degree is no one task's load. Loops and repeated links do no harm; no
    links give no rows.
    """
    both = scratch.keep(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = None
    while True:
        step = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).select("node", F.least("node", "root").alias("root")))
        while True:
            above = step.select(F.col("node").alias("above"), F.col("root").alias("top"))
            jumped = scratch.keep(step.join(above, F.col("root") == F.col("above")).select("node", F.col("root").alias("was"), F.col("top").alias("root")))
            step = jumped.select("node", "root")
            if jumped.filter("was <> root").isEmpty():
                break
        if labels is None:
            labels = step
        else:
            tops = step.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = scratch.keep(labels.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
        for side in ("a", "b"):
            both = both.join(step.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side)
        both = scratch.keep(both.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).filter("a <> b").distinct())
        if both.isEmpty():
            return labels
