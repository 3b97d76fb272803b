"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerflow.sources.shared import store


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every node that has a link.

    Each round takes the smallest root among a node's neighbours and then that root's own root, so the number of
    rounds is about the logarithm of the longest path. Rounds are written to the shared folder.
    """
    both = links.select(F.col(left).alias("x"), F.col(right).alias("y")).where(F.col(left) != F.col(right))
    edges = store(both.union(both.select("y", "x")).distinct(), "edges")
    roots = store(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("x"), F.min("y")).alias("root")), "roots")
    while True:
        seen = edges.join(roots.select(F.col("node").alias("y"), "root"), "y").groupBy(F.col("x").alias("node")).agg(F.min("root").alias("near"))
        low = roots.join(seen, "node").select("node", "root", F.least("root", "near").alias("low"))
        jump = low.join(roots.select(F.col("node").alias("low"), F.col("root").alias("next")), "low", "left")
        after = store(jump.select("node", F.col("root").alias("before"), F.least("low", F.coalesce("next", "low")).alias("root")), "roots")
        moved = after.where(F.col("before") != F.col("root")).limit(1).count()
        roots = after.select("node", "root")
        if not moved:
            return roots
