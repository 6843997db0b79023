"""Benchmark decontamination by size-partitioned MinHash containment search, and exact look-up of short items.

Items are partitioned by the size of their shingle set, in classes of ratio 4 (largest size m). For
each class a document's shingles are cut, in text order, into windows of 2 m with a step of m, so a
passage of an item lies wholly in a window whose size is near its own, however long the document:
the similarity of item and window then has a lower bound, which that of item and document has not.
Windows and items are sketched by one-permutation MinHash with 2 m bins; an equal minimum in any bin makes
a candidate, which exact shingle containment in the whole document then verifies: an item is contained if
100 * shared >= 80 * its shingles. An item of n shingles is missed only if none of its n * 0.8 shared
shingles is the minimum of its bin in the window (each is with probability over 1/3, mostly 3/4). That is too often for few
shingles, so items of up to EXACT shingles are looked up by each of their shingles instead, and items under five words by
their own number of words; none of these is missed.

Items come to the driver in blocks of ITEMS rows at most, are broadcast, and all documents are searched
for each block; nothing is shuffled.

Defined cases: null or empty texts and items contain and match nothing; an item with fewer than five
words is one shingle, contained where this word sequence is; repeated items or rows each give rows; null
ids are carried as null; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import settle, sub_batches, tune, without
from ledgerline.llm.shingles import K, rows_of, runs_of, sets_of, word_counts

PERCENT = 80
ITEMS = 20_000
EXACT = 16
SMALLEST = 64
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
FILTER_BITS = 20


class Table:
    """Items by hashes: sorted, with the item of each."""

    def __init__(self, hashes: list[np.ndarray], owners: list[int]) -> None:
        value = np.concatenate([np.zeros(0, np.uint64), *hashes])
        owner = np.repeat(np.array(owners, np.int64), [len(h) for h in hashes])
        order = np.argsort(value, kind="stable")
        self.value, self.owner = value[order], owner[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.value >> np.uint64(64 - FILTER_BITS)] = True

    def candidates(self, flat: np.ndarray, doc: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) with an equal hash."""
        at = np.flatnonzero(self.filter[flat >> np.uint64(64 - FILTER_BITS)])
        value = flat[at]
        left, right = np.searchsorted(self.value, value, "left"), np.searchsorted(self.value, value, "right")
        hit = left < right
        out = set()
        for r, a, b in sorted(set(zip(doc[at[hit]].tolist(), left[hit].tolist(), right[hit].tolist(), strict=True))):
            out.update((r, o) for o in self.owner[a:b].tolist())
        return out


class SizeClass:
    """The items of one size class: their MinHash minima, sorted, with the item of each."""

    def __init__(self, m: int) -> None:
        self.m, self.bins = m, 2 * m
        self.minima: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []

    def add(self, item: int, s: np.ndarray) -> None:
        table = np.full(self.bins, EMPTY)
        np.minimum.at(table, (s % np.uint64(self.bins)).astype(np.int64), s)
        got = table[table != EMPTY]
        self.minima.append(got)
        self.owners.append(np.full(len(got), item))

    def close(self) -> None:
        value, owner = np.concatenate(self.minima), np.concatenate(self.owners)
        order = np.argsort(value, kind="stable")
        self.value, self.owner = value[order], owner[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.value >> np.uint64(64 - FILTER_BITS)] = True

    def candidates(self, flat: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) with an equal minimum; `flat` holds all documents' shingles, `starts` where each begins."""
        within = np.arange(len(flat)) - starts[doc]
        n_blocks = (np.bincount(doc, minlength=len(starts)) + self.m - 1) // self.m
        first = np.cumsum(n_blocks) - n_blocks
        block = first[doc] + within // self.m
        table = np.full(int(n_blocks.sum()) * self.bins, EMPTY)
        np.minimum.at(table, block * self.bins + (flat % np.uint64(self.bins)).astype(np.int64), flat)
        table = table.reshape(-1, self.bins)
        of_block = np.repeat(np.arange(len(starts)), n_blocks)
        both = of_block[:-1] == of_block[1:]
        windows = table.copy()
        windows[:-1][both] = np.minimum(table[:-1][both], table[1:][both])
        row, col = np.nonzero(self.filter[windows >> np.uint64(64 - FILTER_BITS)])
        value = windows[row, col]
        left, right = np.searchsorted(self.value, value, "left"), np.searchsorted(self.value, value, "right")
        out = set()
        for r, a, b in zip(of_block[row[left < right]].tolist(), left[left < right].tolist(), right[left < right].tolist(), strict=True):
            out.update((r, o) for o in self.owner[a:b].tolist())
        return out


class Items:
    """One block of items: size classes, the table of short items, and for each number of words under K that of items of so many."""

    def __init__(self, items: list[tuple[int | None, str | None]]) -> None:
        self.sets, self.names = sets_of([t for _, t in items]), [i for i, _ in items]
        self.words = word_counts([t for _, t in items]).tolist()
        classes: dict[int, SizeClass] = {}
        by_words: dict[int, list[int]] = {}
        for k, (s, n) in enumerate(zip(self.sets, self.words, strict=True)):
            if len(s) > EXACT:
                m = SMALLEST
                while m < len(s):
                    m *= 4
                classes.setdefault(m, SizeClass(m)).add(k, s)
            elif len(s):
                by_words.setdefault(min(n, K), []).append(k)
        for c in classes.values():
            c.close()
        self.classes = [classes[m] for m in sorted(classes)]
        tables = {n: Table([self.sets[k] for k in own], own) for n, own in by_words.items()}
        self.short = tables.pop(K, None)
        self.tiny = tables


def search(docs: DataFrame, items: list[tuple[int | None, str | None]]) -> DataFrame:
    """Contained items of one block in all documents (id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(Items(items))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sets, names = known.sets, known.names
        for batch in sub_batches(it):
            texts = batch.column("text").to_pylist()
            rows = rows_of(texts)
            sizes = np.array([len(r) for r in rows], np.int64)
            flat = np.concatenate([*rows, np.zeros(0, np.uint64)])
            if not len(flat):
                continue
            doc, starts = np.repeat(np.arange(len(rows)), sizes), np.cumsum(sizes) - sizes
            found = set().union(*(c.candidates(flat, doc, starts) for c in known.classes))
            if known.short:
                found |= known.short.candidates(flat, doc)
            for n_words, text, runs in runs_of(texts, sorted(known.tiny)):
                found |= known.tiny[n_words].candidates(runs, text)
            out = []
            for d, k in sorted(found):
                n = len(sets[k])
                common = n if known.words[k] < K else int(np.isin(sets[k], rows[d]).sum())
                if 100 * common >= PERCENT * n:
                    out.append((batch.column("id")[d].as_py(), names[k], n, common))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in zip(*out, strict=True)], ["id", "item_id", "n_shingles", "n_shared"])

    return docs.mapInArrow(run, "id bigint, item_id bigint, n_shingles bigint, n_shared bigint")


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """`id_col`, item_id, n_shingles, n_shared, containment for every item that a document contains."""
    tune(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts, block = [], []
    for r in benchmark.select(F.col(item_col).cast("bigint"), F.col(item_text_col).cast("string")).toLocalIterator():
        block.append((r[0], r[1]))
        if len(block) == ITEMS:
            parts.append(settle(search(source, block), "found"))
            block = []
    if block or not parts:
        parts.append(search(source, block))
    found = reduce(DataFrame.union, parts)
    return found.select(F.col("id").alias(id_col), "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that contain no benchmark item. The ids found are written first, so the search is made once."""
    found = settle(contained_items(docs, benchmark, id_col, text_col).select(id_col).distinct(), "contaminated")
    return without(docs, found, id_col)
