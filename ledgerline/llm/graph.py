"""Connected components of a stored edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import store

#: Rounds halve chains; this many are enough for any graph that fits a cluster.
MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of ``edges`` (``a``, ``b``) that is not its own root.

    Each round hangs every node's larger neighbours, then its smaller ones, onto its smallest neighbour. The edges are
    written after each round to the shared folder. A node with many edges is an aggregate that combines before the
    shuffle, and a join whose large side Spark may split. Loops are ignored, null ends too.
    """
    linked = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    current, mark = store(linked.distinct(), "edges"), None
    for _ in range(MAX_ROUNDS):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        current = store(after, "edges")
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError("components did not settle")
