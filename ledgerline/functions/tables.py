"""Table functions for SQL: the text nodes of pages, one-to-one matches and connected components, each over TABLE(...) PARTITION BY its key.

A table function sees the rows of one partition in order, so a partition is what a call may hold: a page, the two lists of a key, the edges of a block.
The rows it gives are those of the DataFrame forms. The schema of an argument is checked when the query is analysed.

    SELECT * FROM html_nodes(TABLE(SELECT page_id AS id, html FROM pages) PARTITION BY id)
    SELECT * FROM greedy_match(TABLE(lists) PARTITION BY block, floor => 60)
    SELECT * FROM components(TABLE(edges) PARTITION BY block)
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ledgerline.sources.shipping import ship


def fields_of(table: AnalyzeArgument, names: list[str], function: str) -> dict[str, T.DataType]:
    """The types of a table argument's columns, by name; an error that says which are missing."""
    if not table.isTable:
        raise ValueError(f"{function}: the first argument has to be a table")
    kinds = {f.name: f.dataType for f in table.dataType.fields}
    if missing := [n for n in names if n not in kinds]:
        raise ValueError(f"{function}: the table has no column {', '.join(missing)}; it has {', '.join(kinds)}")
    return kinds


def schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


class HtmlNodes:
    """id, ord, text, in_link, bold, italic, heading, block of the text nodes of pages (id, html)."""

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        kinds = fields_of(table, ["id", "html"], "html_nodes")
        flags = {name: T.BooleanType() for name in ("in_link", "bold", "italic")}
        return AnalyzeResult(schema(id=kinds["id"], ord=T.LongType(), text=T.StringType(), **flags, heading=T.StringType(), block=T.LongType()))

    def eval(self, row: Any) -> Iterator[tuple]:
        from ledgerline.operators.matching import text_nodes

        for k, node in enumerate(text_nodes(row["html"] or "")):
            yield (row["id"], k, *node)


class GreedyMatch:
    """block, left_id, right_id, score: the best pairs of a block's two lists (block, side, id, text), one to one, down to `floor`."""

    def __init__(self) -> None:
        self.block, self.sides, self.floor = None, {"left": [], "right": []}, 0.0

    @staticmethod
    def analyze(table: AnalyzeArgument, floor: AnalyzeArgument) -> AnalyzeResult:
        kinds = fields_of(table, ["block", "side", "id", "text"], "greedy_match")
        return AnalyzeResult(schema(block=kinds["block"], left_id=kinds["id"], right_id=kinds["id"], score=T.DoubleType()))

    def eval(self, row: Any, floor: float) -> None:
        self.block, self.floor = row["block"], float(floor)
        if row["side"] not in self.sides:
            raise ValueError("greedy_match: side is left or right")
        if row["text"] is not None:
            self.sides[row["side"]].append((row["id"], row["text"]))

    def terminate(self) -> Iterator[tuple]:
        from ledgerline.operators.matching import greedy

        for pair in greedy(sorted(self.sides["left"]), sorted(self.sides["right"]), self.floor):
            yield (self.block, *pair)


class Components:
    """block, node, root of the nodes of a block's edges (block, a, b): the smallest node of the component."""

    def __init__(self) -> None:
        self.block, self.edges = None, []

    @staticmethod
    def analyze(table: AnalyzeArgument) -> AnalyzeResult:
        kinds = fields_of(table, ["block", "a", "b"], "components")
        return AnalyzeResult(schema(block=kinds["block"], node=kinds["a"], root=kinds["a"]))

    def eval(self, row: Any) -> None:
        self.block = row["block"]
        if row["a"] is not None and row["b"] is not None:
            self.edges.append((row["a"], row["b"]))

    def terminate(self) -> Iterator[tuple]:
        from ledgerline.operators.graph import roots

        for node, root in roots(self.edges).items():
            yield self.block, node, root


def register(spark: SparkSession) -> None:
    """html_nodes, greedy_match and components, for spark.sql of this session."""
    ship(spark)
    for name, function in (("html_nodes", HtmlNodes), ("greedy_match", GreedyMatch), ("components", Components)):
        spark.udtf.register(name, udtf(function))
