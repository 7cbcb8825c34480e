"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskscan.llm.common import checkpointed


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links ``a``, ``b``: all nodes that links connect have one root.

    Each round every node takes the node beside it, or itself, that is first in an
    order which each round draws anew by hash, and then takes what that one took;
    links are drawn anew between what was taken, and those that fall together go.
    As the order is random, a constant share of nodes goes in each round, in a
    long chain as in a star.  A node with many links costs one row per task in
    the minimum, and joins have one row per node on one side.  Each round ends in
    a checkpoint.
    """
    links = checkpointed(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    named, salt = None, 0
    while not links.isEmpty():
        salt += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(salt), F.col(c)).alias("rank"), F.col(c).alias("node"))  # noqa: B023, E731
        ways = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = checkpointed(ways.groupBy("a").agg(F.min(rank("b")).alias("_near")).select(
            F.col("a").alias("_node"), F.least(rank("a"), F.col("_near"))["node"].alias("_up")
        ))
        above = near.select(F.col("_node").alias("_up"), F.col("_up").alias("_top"))
        step = checkpointed(near.join(above, "_up", "left").select("_node", F.coalesce("_top", "_up").alias("_to")))
        moved = lambda df, c: df.join(  # noqa: B023, E731
            step.select(F.col("_node").alias(c), F.col("_to").alias(f"_{c}")), c, "left"  # noqa: B023
        ).withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
        named = step.select(F.col("_node").alias("node"), F.col("_to").alias("root")) if named is None else moved(named, "root")
        named = checkpointed(named)
        links = moved(moved(links, "a"), "b").where("a <> b")
        links = checkpointed(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if named is None:
        named = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return named
