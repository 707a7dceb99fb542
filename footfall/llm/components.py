"""Connected components of a link table, without collecting links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (links, in any order, repeats allowed) → ``node, root``, one root for each component.

    Each round sends every node to the smallest node within two links of where that one is sent itself, and
    goes on with the links between the nodes that are left. Stars, however large, close in one round, chains
    shrink by more than half. The smallest node is a running minimum, so no group is ever gathered.
    """
    left = cut_lineage(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = cut_lineage(left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")))
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")))
        beyond = both.join(near.select(F.col("a").alias("b"), "low"), "b").groupBy("a").agg(F.min("low").alias("low"))
        jump = cut_lineage(beyond)
        sent = jump.alias("x").join(jump.alias("y"), F.col("x.low") == F.col("y.a"), "left")
        target = cut_lineage(sent.select(F.col("x.a").alias("from"), F.coalesce("y.low", "x.low").alias("to")))
        labels = cut_lineage(
            labels.join(target, labels["root"] == target["from"], "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        )
        heads = target.select(F.col("from").alias("a"), F.col("to").alias("ta"))
        tails = target.select(F.col("from").alias("b"), F.col("to").alias("tb"))
        moved = left.join(heads, "a").join(tails, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        left = cut_lineage(
            moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        )
    return labels
