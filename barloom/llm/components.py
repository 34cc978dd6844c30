"""Connected components of a table of links, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.sinks.writers import written


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """One round: neighbours of a node move to the smallest node they know.

    ``larger`` moves the neighbours above the node, the other round those below it and the node.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if larger:
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.where("b < a")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, files: int) -> DataFrame:
    """``node, root`` of every node that has a link (``a, b``); the root is the smallest node.

    ``files`` is the number of files of a round's table. The rounds end when every link points at
    its root, after a number of rounds that grows with the logarithm of the longest path. Each
    round is written, so a lost executor repeats one round.
    """
    now = links.where("a <> b").distinct()
    seen = None
    while True:
        now = written(_stars(_stars(now, larger=True), larger=False).coalesce(files), "links")
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
