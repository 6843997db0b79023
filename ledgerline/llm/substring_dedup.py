"""Substring deduplication by content-defined chunking.

A gear rolling hash over the last 16 bytes decides after which white space a chunk ends, so an
insertion moves no border but those next to it; chunks have at least MIN_BYTES. Farther than FAR_BYTES
from the last white space the hash alone cuts, so texts without white space (Chinese, Japanese, Thai, base64) have
chunks of the same size; this too depends only on the bytes just before, whatever the stretch's length. No chunk has more than
MAX_BYTES: longer ones (periodic text) are cut there, at a character's start.

What is compared over all documents are passages: from each chunk on, and back from each chunk, the fewest chunks that hold RUN_WORDS
words, a long word counting once for each WORD_BYTES. Each has a 96-bit digest, and stays in the document with the
smallest id; a document loses the union of its passages that a document with a smaller id has too. So all that is removed stood
together in one earlier document: chunks that are equal by chance, or a text put together from chunks of many
documents, lose nothing. Of a repeated passage of over 50 words, the parts of chunks at its ends stay.

Chunks are made once and written. Digests that more than 1 / HOT_SHARE of all passages have are a bounded table and are
broadcast, so a passage that a third of all documents share is looked up where its rows lie; the others are joined by digest.
Only places of repeated passages go back to the documents, and only texts that may have some are shuffled to meet them.

Defined cases: null text stays null and empty text empty; rows with one doc_id are one document,
whose repeats of itself stay; rows with a null doc_id are neither compared nor changed; ids are integers; an empty table gives an
empty result. Repeats within one document are left alone. Ties (a passage in several documents) go to the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import discard, parted, settle, shared_folder, sub_batches, tune

MIN_BYTES = 24
#: One white space in so many ends a chunk, once it has MIN_BYTES.
ONE_IN = 4
#: Farther than this from white space, one place between characters in so many ends a chunk.
FAR_BYTES, FAR_ONE_IN = 48, 8
#: The greatest chunk.
MAX_BYTES = 1024
#: Digests that one in so many passages has, or more, are looked up by broadcast.
HOT_SHARE = 10_000
#: Words of a passage; a longer word counts as one for each WORD_BYTES.
RUN_WORDS, WORD_BYTES = 15, 12
#: White space of the word contracts. Fixed values.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_table() -> np.ndarray:
    """A random 32-bit number for each byte value, made by a fixed rule."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], np.uint32)


GEAR = gear_table()


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the sum over the last 16 bytes of GEAR, shifted by their age; by doubling of windows."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        if len(h) > width:
            older = h.copy()
            h[width:] += older[:-width] << np.uint32(width)
    return h * np.uint32(0x9E3779B1)


def borders(raw: bytes) -> list[int]:
    """Where the chunks of a text begin, and its end; [0] for an empty text."""
    if not raw:
        return [0]
    data = np.frombuffer(raw, np.uint8)
    h = gear(data)
    space = IS_SPACE[data]
    found = space[:-1] & ~space[1:] & (h[:-1] < np.uint32((1 << 32) // ONE_IN))
    places = np.r_[-1, np.flatnonzero(space), len(data)]
    if np.diff(places).max() > FAR_BYTES:
        since = np.arange(len(data)) - np.repeat(places[:-1], np.diff(places))[1:]
        starts = (data[1:] & 0xC0) != 0x80
        found |= (since[:-1] > FAR_BYTES) & starts & (h[:-1] < np.uint32((1 << 32) // FAR_ONE_IN))
    out, last = [0], 0
    for at in [*(np.flatnonzero(found) + 1).tolist(), len(raw)]:
        while at - last > MAX_BYTES:
            last += MAX_BYTES
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if at - last >= MIN_BYTES or at == len(raw):
            out.append(at)
            last = at
    return out


def words_before(raw: bytes, edges: list[int]) -> np.ndarray:
    """How many words begin before each edge; a long word counts again at each further WORD_BYTES that it has in full."""
    data = np.frombuffer(raw, np.uint8)
    space = IS_SPACE[data]
    if not len(data):
        return np.zeros(len(edges), np.int64)
    begins = np.flatnonzero(~space & np.r_[True, space[:-1]])
    ends = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
    more = np.maximum((ends - begins) // WORD_BYTES - 1, 0)
    if more.any():
        extra = np.repeat(begins, more) + WORD_BYTES * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1)
        begins = np.sort(np.concatenate([begins, extra]))
    return np.searchsorted(begins, edges, "left")


def passages(raw: bytes) -> list[tuple[int, int]]:
    """Byte spans: from each chunk on, and back from each chunk, the fewest chunks that hold RUN_WORDS words. Distinct, in order."""
    edges = borders(raw)
    count = words_before(raw, edges)
    n = len(edges)
    stop = np.searchsorted(count, count + RUN_WORDS, "left")
    start = np.searchsorted(count, count - RUN_WORDS, "right") - 1
    here = np.arange(n)
    codes = np.unique(np.concatenate([(here * n + stop)[stop < n], (start * n + here)[start >= 0]]))
    at = np.array(edges)
    return list(zip(at[codes // n].tolist(), at[codes % n].tolist(), strict=True))


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans as disjoint ones in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def removed(raw: bytes, flagged: list[int]) -> list[tuple[int, int]]:
    """Byte spans to remove: the union of the passages of the given numbers."""
    own = passages(raw)
    return united([own[k] for k in flagged])


def passage_places(docs: DataFrame) -> DataFrame:
    """(d1, d2, id, at) of every passage of `docs` (id, text): the digest's two parts, and the passage's number in its document."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it):
            digests, ids, ats = [], [], []
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass") if text else b""
                spans = passages(raw)
                digests += [xxhash.xxh3_128_digest(raw[a:b])[:12] for a, b in spans]
                ats += range(len(spans))
                ids.append(np.full(len(spans), i))
            if ats:
                parts = np.frombuffer(b"".join(digests), [("d1", "<i8"), ("d2", "<i4")])
                cols = [pa.array(np.ascontiguousarray(parts["d1"])), pa.array(np.ascontiguousarray(parts["d2"])), pa.array(np.concatenate(ids).astype(np.int64)), pa.array(np.array(ats, np.int32))]
                yield pa.RecordBatch.from_arrays(cols, ["d1", "d2", "id", "at"])

    return docs.where("id is not null").mapInArrow(run, "d1 bigint, d2 int, id bigint, at int")


def repeated_places(docs: DataFrame, work: str) -> DataFrame:
    """(id, ats): for each document the places of passages that a document with a smaller id has too."""
    places = settle(passage_places(docs), "passages", work)
    first = places.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n")).where("first < last")
    first = settle(first.select("d1", "d2", "first", "n"), "first", work)
    total = places.count()
    many = F.col("n") * HOT_SHARE >= total
    hot = F.broadcast(first.where(many).select("d1", "d2", "first"))  # at most HOT_SHARE rows
    rare = first.where(~many).select("d1", "d2", "first")
    here = places.join(hot, ["d1", "d2"], "left")
    here_too = here.where(F.coalesce("first", "id") < F.col("id"))  # a digest has one row in `hot`, so the join gives as many rows as there are places
    hits = here_too.select("id", "at").union(here.where("first is null").drop("first").join(rare, ["d1", "d2"]).where("id > first").select("id", "at"))
    return hits.groupBy("id").agg(F.collect_set("at").alias("ats"))  # at most twice the chunks of one text


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`id_col` (as bigint), text without repeated passages, n_removed (code points), spans (byte offsets in the old text) of every row, and the columns to carry."""
    tune(docs.sparkSession)
    carry = carry or []
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), *carry)
    work = shared_folder(docs.sparkSession)
    marks = settle(repeated_places(source.select("id", "text"), work), "repeats")
    discard(docs.sparkSession, work)
    whole, cut = parted(source, marks, "id")
    joined = cut.join(marks, "id", "left").select("id", "text", "ats", *carry)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it):
            texts, counts, all_spans = [], [], []
            for text, ats in zip(batch.column("text").to_pylist(), batch.column("ats").to_pylist(), strict=True):
                spans = []
                if text and ats:
                    raw = text.encode("utf-8", "surrogatepass")
                    if spans := removed(raw, ats):
                        ends = [0, *[x for s in spans for x in s], len(raw)]
                        kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)).decode("utf-8", "surrogatepass")
                        counts.append(len(text) - len(kept))
                        text = kept
                if not spans:
                    counts.append(0)
                texts.append(text)
                all_spans.append([{"start": a, "stop": b} for a, b in spans])
            span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(all_spans, span_type), *(batch.column(c) for c in carry)], ["id", "text", "n_removed", "spans", *carry])

    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[2:])
    spans = "array<struct<start:int,stop:int>>"
    out = joined.mapInArrow(run, f"id bigint, text string, n_removed bigint, spans {spans}{kinds}")
    whole = whole.select("id", "text", F.lit(0).cast("bigint").alias("n_removed"), F.array().cast(spans).alias("spans"), *carry)
    return whole.union(out).withColumnRenamed("id", id_col)
