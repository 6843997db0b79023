"""Connected components of an edge table by alternating large-star and small-star steps (public algorithm).

Every step is a grouped minimum and a join on a node, so no component is ever gathered in one task;
after O(log^2 n) rounds each edge leads from a node to the smallest node of its component. The edges
of each round are written to the shared folder, which cuts the lineage; those of the round before are deleted. An empty table gives an empty one.

Each round counts its edges. Up to FEW, they are dealt out by node over as many tasks as A_TASK asks for, and grouping, join and
distinct share that exchange; a node that holds all of them is within one task's bound then. Beyond, Spark sizes and splits the tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import discard, settle, shared_folder

#: Edges that are dealt out by node at most, and how many of them a task takes on average.
FEW, A_TASK = 2_000_000, 100_000


def dealt(edges: DataFrame, n: int) -> DataFrame:
    """`edges` by node `a`, in tasks sized by their number `n`, if that is FEW at most; otherwise as they are."""
    return edges.repartition(-(-n // A_TASK) or 1, "a") if n <= FEW else edges


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (columns a, b) that is not its own root. Self edges and nulls are ignored."""
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    spark, folder = edges.sparkSession, shared_folder(edges.sparkSession)
    now, turn, before = settle(edges.where("a <> b").select(a, b).distinct(), "edges0", folder), 0, None
    while (mark := now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != before:
        before, n = mark, 2 * mark[0]
        both = dealt(now.union(now.select("b", "a")), n)
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = dealt(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")), n).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        turn += 1
        now = settle(dealt(small.select("e.a", "e.b").where("a <> b"), n).distinct(), f"edges{turn}", folder)
        discard(spark, f"{folder}/edges{turn - 1}")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
