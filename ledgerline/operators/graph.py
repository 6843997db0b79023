"""Connected components of edges, within blocks (a date, a document) or over a whole table.

Small blocks go to a union-find, many in one call. The edges of larger ones, and of tables without blocks, go through rounds of joins:
each node takes the smallest label among its own, its neighbours' and its label's (pointer jumping), until a round changes nothing. No component is
ever gathered in a task, and each round is written before the next.

Defined cases: repeated and self edges change nothing; edges with a null end are ignored; a null block is a block of its own; an empty table gives an empty one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.shipping import ship
from ledgerline.sources.stages import Stages

#: Edges of a block that is not split, and of the blocks that share a call, about.
MOST_EDGES = 100_000


def roots(edges: list[tuple]) -> dict:
    """The smallest node of each node's component."""
    parent: dict = {}

    def top(x):  # noqa: ANN001, ANN202  nodes of any one type
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {x: top(x) for x in list(parent)}


def components_in_blocks(edges: DataFrame, most: int = MOST_EDGES) -> DataFrame:
    """block, node, root of the nodes of `edges` (block, a, b): the root is the smallest node of the component."""
    spark = edges.sparkSession
    ship(spark)
    found = Stages(spark).keep(edges.select("block", "a", "b").where("a is not null and b is not null"))
    calls = found.count() // max(most, 1) + 1
    sizes = found.groupBy("block").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > most).select(F.col("block").alias("of"))
    block, kind = found.schema["block"].dataType, found.schema["a"].dataType.simpleString()

    def unite(table: pa.Table) -> pa.Table:
        blocks, a, b = (table[c].to_pylist() for c in ("block", "a", "b"))
        got = roots(list(zip(zip(blocks, a, strict=True), zip(blocks, b, strict=True), strict=True)))
        return pa.table({"block": pa.array([x for x, _ in got], table["block"].type), "node": pa.array([x for _, x in got], table["a"].type), "root": pa.array([x for _, x in got.values()], table["a"].type)})

    same = F.col("block").eqNullSafe(F.col("of"))
    small = found.join(large, same, "left_anti").groupBy(F.pmod(F.xxhash64("block"), F.lit(calls))).applyInArrow(unite, f"block {block.simpleString()}, node {kind}, root {kind}")
    return small.union(components(found.join(large, same, "left_semi"))) if large.limit(1).count() else small


def components(edges: DataFrame) -> DataFrame:
    """block, node, root like `components_in_blocks`, by rounds of joins for blocks of any size; without a column block, node and root over the table."""
    whole = "block" not in edges.columns
    found = edges.select((F.lit(0) if whole else F.col("block")).alias("block"), "a", "b").where("a is not null and b is not null")
    stages = Stages(edges.sparkSession)
    both = stages.keep(found.union(found.select("block", F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    nodes = ["block", "a"]
    by_block = lambda x, y: F.col(f"{x}.block").eqNullSafe(F.col(f"{y}.block"))
    label = stages.keep(both.groupBy(*nodes).agg(F.least(F.col("a"), F.min("b")).alias("root")))
    while True:
        near = both.alias("e").join(label.alias("l"), by_block("e", "l") & (F.col("e.b") == F.col("l.a"))).select("e.block", "e.a", "l.root")
        least = near.union(label.select("block", "a", "root")).groupBy(*nodes).agg(F.min("root").alias("root"))
        jump = least.alias("x").join(label.alias("y"), by_block("x", "y") & (F.col("x.root") == F.col("y.a"))).select("x.block", "x.a", F.least("x.root", "y.root").alias("root"))
        new = stages.keep(jump)
        moved = new.alias("x").join(label.alias("y"), by_block("x", "y") & (F.col("x.a") == F.col("y.a"))).where("x.root <> y.root").limit(1).count()
        stages.drop(stages.number - 1)
        label = new
        if not moved:
            out = label.select("block", F.col("a").alias("node"), "root")
            return out.drop("block") if whole else out
