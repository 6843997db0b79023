"""Greedy one-to-one matching of two lists by fuzzy score, within blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heapreplace
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import indel_ratio


def greedy(left: list[tuple[int, str]], right: list[tuple[int, str]], floor: float) -> list[tuple[int, int, float]]:
    """One-to-one pairs, the best first, down to the floor; ties go to the later ordinals.

    Rows of one text have the same scores, so texts are scored, not rows: one score at a time, from the best, the texts that have it with another
    give their ordinals from the last, each to the last one that is left of the other side. A left ordinal that finds none at a score leaves
    its whole text without one there, so the work is that of the scored texts and the pairs taken. Only texts whose lengths leave room for the floor are scored.
    """
    x, y = by_text(left), by_text(right)
    levels: dict[float, dict[str, list[str]]] = {}
    for a in x:
        for b in y:
            if most_ratio(len(a), len(b)) >= floor and (s := indel_ratio(a, b)) >= floor:
                levels.setdefault(s, {}).setdefault(a, []).append(b)
    out: list[tuple[int, int, float]] = []
    for s in sorted(levels, reverse=True):
        partners = levels[s]
        heap = [(-x[a][-1], a) for a in partners if x[a]]
        heapify(heap)
        while heap:
            a = heap[0][1]
            partners[a] = rest = [b for b in partners[a] if y[b]]
            if not rest:
                heappop(heap)
                continue
            out.append((x[a].pop(), y[max(rest, key=lambda b: y[b][-1])].pop(), s))
            if x[a]:
                heapreplace(heap, (-x[a][-1], a))
            else:
                heappop(heap)
    return out


def by_text(rows: list[tuple[int, str]]) -> dict[str, list[int]]:
    """The ordinals of each text, ascending; of a repeated ordinal the last text counts."""
    out: dict[str, list[int]] = {}
    for i, t in sorted(dict(rows).items()):
        out.setdefault(ordered(t), []).append(i)
    return out


def ordered(text: str) -> str:
    return " ".join(sorted(text.lower().split()))


def most_ratio(a: int, b: int) -> float:
    """The greatest ratio that texts of these lengths may have."""
    return 200.0 * min(a, b) / (a + b) if a + b else 100.0


def greedy_match(current: DataFrame, prior: DataFrame, block: str, ordinal: str, text: str, floor: float = 60.0) -> DataFrame:
    """(block, left, right, score) of each block. A block (two years' headings of one company) is small by nature and lies in one task."""
    both = current.select(block, F.lit(True).alias("now"), F.col(ordinal).alias("o"), F.col(text).alias("t")).unionByName(prior.select(block, F.lit(False).alias("now"), F.col(ordinal).alias("o"), F.col(text).alias("t")))
    kind = both.schema[block].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pick = lambda now: [(int(o), t) for o, t in zip(pdf.o[pdf.now == now], pdf.t[pdf.now == now], strict=True) if t is not None]
        rows = greedy(pick(True), pick(False), floor)
        return pd.DataFrame([(pdf[block].iloc[0], *r) for r in rows], columns=[block, "left_ord", "right_ord", "score"])

    return both.groupBy(block).applyInPandas(run, f"{block} {kind}, left_ord bigint, right_ord bigint, score double")


#: Elements without an end, those that make a paragraph, and how many of the nearest elements style a text. Fixed values.
VOID = {"br", "hr", "img", "input", "meta", "link"}
BLOCKS = {"p", "div", "tr", "li", "td", "th", "h1", "h2", "h3", "h4", "br", "table"}
NEAREST = 4


class Nodes(HTMLParser):
    """Text nodes with what the elements around them say: (text, in_link, bold, italic, heading, block). `block` numbers the nearest paragraph-like element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, int]] = []  # name, bold, italic, its number if it is a block
        self.blocks = 0
        self.rows: list[tuple[str, bool, bool, bool, str | None, int]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            return
        style = dict(attrs).get("style") or ""
        self.blocks += tag in BLOCKS
        bold = tag in ("b", "strong") or bool(re.search(r"font-weight:\s*(bold|[7-9]00)", style))
        italic = tag in ("i", "em") or bool(re.search(r"font-style:\s*italic", style))
        self.open.append((tag, bold, italic, self.blocks if tag in BLOCKS else 0))

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        words, tags = " ".join(data.split()), {name for name, *_ in self.open}
        if words and not tags & {"script", "style"}:
            near = self.open[-NEAREST:]
            head = next((t for t, *_ in self.open if re.fullmatch("h[1-6]", t)), None)
            block = next((n for *_, n in reversed(self.open) if n), 0)
            self.rows.append((words, "a" in tags, any(b for _, b, *_ in near), any(i for _, _, i, _ in near), head, block))


def text_nodes(html: str) -> list[tuple[str, bool, bool, bool, str | None, int]]:
    """The rows of `Nodes` of a page."""
    parser = Nodes()
    parser.feed(html)
    return parser.rows


def html_nodes(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Text nodes of each page in order: (id, ord, text, in_link, bold, italic, heading, block)."""
    source = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = [(i, k, *row) for i, text in zip(pdf.id, pdf.html, strict=True) for k, row in enumerate(text_nodes(text or ""))]
            yield pd.DataFrame(out, columns=["id", "ord", "text", "in_link", "bold", "italic", "heading", "block"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInPandas(run, f"id {kind}, ord bigint, text string, in_link boolean, bold boolean, italic boolean, heading string, block bigint").withColumnRenamed("id", id_col)
