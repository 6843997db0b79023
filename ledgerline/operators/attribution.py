"""Which source a quotation comes from. An automaton over many quotations reads each source once, whatever their number and length.

Two forms. `attribute` checks each fact against the sources that it lists, in their order: quotations meet their sources by an equi-join, as one row
for each source; a source that very many facts list is read once for each part of their quotations, and near misses are told from paraphrases.
`first_containing` looks for a set of quotations in every source, which is read once: for an automaton that is broadcast, or, where the quotations are too
many for one, for windows whose hashes a table of bits has, of bounded size. Those windows meet the quotations by an equi-join, so the table decides nothing.

Defined cases: a null quotation is an empty one; a null source text is unavailable and contains nothing; a fact without listed sources
is not verified; repeated listings count once, at their first place; repeated rows of a source are each read. Sources without an id are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.quotes import NEAR, Canonical, agreement, verdict
from ledgerline.functions.text import SHORTEST, TAIL, canonical
from ledgerline.sources.shipping import ship
from ledgerline.sources.stages import Stages

#: Characters of the quotations of one automaton, about; a longer quotation is one by itself. What a quotation counts besides its characters.
BLOCK_CHARS, ROW_CHARS = 1_000_000, 64
#: Characters of texts whose windows are hashed at once; bits of the table for each quotation, and its least and greatest size as a power of 2.
SPAN_CHARS, BITS_EACH, LEAST_BITS, MOST_BITS = 1 << 18, 16, 16, 27
#: Odd numbers that spread hashes, and other constants of their arithmetic.
BASE, SALT, SPREAD, HALF, ONE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, np.uint64(0xBF58476D1CE4E5B9), np.uint64(32), np.uint64(1)
#: Quotations that are looked for one by one, as an automaton costs more than that.
FEW = 16
UNAVAILABLE, UNLISTED = "source text unavailable", "no sources to check against"


class Finder:
    """An automaton over texts and, for near misses, over the beginnings of them that decide: those up to TAIL short, and the share NEAR."""

    def __init__(self, texts: Iterable[str], near: bool = False) -> None:
        self.texts = sorted(set(texts))
        self.everywhere = [k for k, t in enumerate(self.texts) if not t]
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, text in enumerate(self.texts):
            n = len(text)
            for size in {n, math.ceil(NEAR * n), *range(max(SHORTEST, n - TAIL), n)} if near and n >= SHORTEST else {n}:
                if size:
                    owners.setdefault(text[:size], []).append((k, size))
        self.automaton = ahocorasick.Automaton()
        for pattern, who in owners.items():
            self.automaton.add_word(pattern, tuple(who))
        if owners:
            self.automaton.make_automaton()

    def found(self, hay: str) -> dict[int, int]:
        """For each text with a beginning in the hay, the number of its characters found so far: all of them, or a decisive beginning."""
        best = dict.fromkeys(self.everywhere, 0)
        if len(self.automaton):
            for who in {who for _, who in self.automaton.iter(hay)}:
                for k, size in who:
                    best[k] = max(best.get(k, 0), size)
        return best


def agreements(texts: set[str], hay: str) -> dict[str, int]:
    """For each canonical quotation the number of its first characters that the hay holds, or one that decides alike."""
    if len(texts) <= FEW:
        return {t: len(t) if t in hay else agreement(t, hay) if len(t) >= SHORTEST else 0 for t in texts}
    finder = Finder(texts, near=True)
    found = {finder.texts[k]: n for k, n in finder.found(hay).items()}
    return {t: n if (n := found.get(t, 0)) in (0, len(t)) else agreement(t, hay) for t in texts}


def attribute(facts: DataFrame, listing: DataFrame, sources: DataFrame) -> DataFrame:
    """fact_id, source_id, verified, why, span of each fact (fact_id, quote): the first of its sources by place that holds its quotation.

    `listing`: fact_id, place, source_id. `sources`: source_id, text. Where no source holds it, source_id is null, `why` says
    for each in order why not, and the span is the quotation as it stands.
    """
    ship(facts.sparkSession)
    facts = facts.select("fact_id", F.coalesce("quote", F.lit("")).alias("quote"))
    listed = listing.where("source_id is not null").groupBy("fact_id", "source_id").agg(F.min("place").alias("place"))
    asked = listed.join(facts, "fact_id")
    sizes = asked.groupBy("source_id").agg(F.ceil(F.sum(F.length("quote") + ROW_CHARS) / BLOCK_CHARS).cast("int").alias("parts"))
    dealt = asked.join(sizes, "source_id").withColumn("part", F.pmod(F.xxhash64("quote", "fact_id"), F.col("parts")).cast("int"))
    asks = dealt.repartition("source_id", "part").groupBy("source_id", "part").agg(F.collect_list(F.struct("fact_id", "place", "quote", F.xxhash64("quote").alias("q"))).alias("asks"))  # of bounded size
    read = sources.select("source_id", "text").join(sizes, "source_id").select("source_id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text")
    id_type, place_type, source_type = dealt.schema["fact_id"].dataType.simpleString(), dealt.schema["place"].dataType.simpleString(), dealt.schema["source_id"].dataType.simpleString()

    def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            parents, each = pc.list_parent_indices(batch.column("asks")), batch.column("asks").flatten()
            quotes, first = each.field("quote").to_pylist(), 0
            own = {q: Canonical(q) for q in set(quotes)}
            agreed: list[int] = []
            for text, n in zip(batch.column("text").to_pylist(), pc.list_value_length(batch.column("asks")).to_pylist(), strict=True):
                these, first = [own[q].text for q in quotes[first : first + n]], first + n
                same = agreements(set(these), canonical(text)) if text is not None else {}
                agreed += [-1 if text is None else same[t] for t in these]
            rows = [(False, UNAVAILABLE, "") if n < 0 else verdict(own[q], n) for q, n in zip(quotes, agreed, strict=True)]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.bool_(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([each.field("fact_id"), each.field("place"), batch.column("source_id").take(parents), each.field("q"), pa.array(agreed, pa.int32()), *columns], ["fact_id", "place", "source_id", "q", "same", "holds", "why", "span"])

    told = asks.join(read, ["source_id", "part"], "left").select("source_id", "text", "asks")
    found = told.mapInArrow(judge, f"fact_id {id_type}, place {place_type}, source_id {source_type}, q bigint, same int, holds boolean, why string, span string")
    best = F.max_by(F.struct("holds", "why", "span"), "same")  # of the repeated rows of a source
    checked = found.repartition("fact_id").groupBy("fact_id", "source_id", "place", "q").agg(best.alias("v")).select("fact_id", "source_id", "place", "v.*")
    miss = F.struct("place", F.concat(F.col("source_id").cast("string"), F.lit(": "), F.col("why")).alias("miss"))
    by_fact = checked.groupBy("fact_id").agg(F.expr("min_by(struct(source_id, why, span), place) filter (where holds)").alias("hit"), F.array_join(F.array_sort(F.collect_list(miss))["miss"], "; ").alias("misses"))
    why = F.coalesce("hit.why", "misses", F.lit(UNLISTED))
    return facts.join(by_fact, "fact_id", "left").select("fact_id", F.col("hit.source_id").alias("source_id"), F.col("hit").isNotNull().alias("verified"), why.alias("why"), F.coalesce("hit.span", "quote").alias("span"))


def first_containing(quotes: DataFrame, sources: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """quote, source_id for each distinct text of `quotes` (quote) that a text of `sources` (source_id, text) contains as it is: the smallest such id."""
    spark = quotes.sparkSession
    ship(spark)
    distinct = quotes.select("quote").where("quote is not null").distinct()
    read = sources.select("source_id", "text").where("source_id is not null and text is not null")
    kind = f"quote string, source_id {read.schema['source_id'].dataType.simpleString()}"
    if (distinct.agg(F.sum(F.length("quote"))).first()[0] or 0) <= block_chars:
        texts = [r["quote"] for r in distinct.collect()]  # of bounded size
        return read.mapInArrow(scan(spark.sparkContext.broadcast(texts)), kind).groupBy("quote").agg(F.min("source_id").alias("source_id"))
    distinct = Stages(spark).keep(distinct)
    lengths = {r["n"]: r["rows"] for r in distinct.groupBy(F.length("quote").alias("n")).agg(F.count("*").alias("rows")).collect()}  # a row for each length
    log = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(BITS_EACH * sum(lengths.values())))))
    words = distinct.mapInArrow(marked(log), "word bigint, bits bigint").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()  # 16 MB of bits at most
    table = np.zeros(1 << log - 6, np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    found = read.mapInArrow(windows(spark.sparkContext.broadcast(table), log, sorted(lengths)), kind).groupBy("quote").agg(F.min("source_id").alias("source_id"))
    return distinct.join(found, "quote")


def scan(shared):  # noqa: ANN001, ANN201  a broadcast of texts; a function over Arrow batches
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, least, kind = Finder(shared.value), {}, None
        for batch in it:
            kind = batch.column(0).type
            for source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k in finder.found(text):
                    if k not in least or source < least[k]:
                        least[k] = source
        if least:
            yield pa.RecordBatch.from_arrays([pa.array([finder.texts[k] for k in least], pa.string()), pa.array(list(least.values()), kind)], ["quote", "source_id"])

    return run


class Hashes:
    """Hashes of any windows of a text: sums of its characters' numbers times powers of an odd number, shifted back by the powers of its inverse modulo 2**64."""

    def __init__(self, text: str) -> None:
        codes = (np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + ONE) * SPREAD
        codes ^= codes >> HALF
        powers, self.back = powers_to(max(10, len(codes).bit_length()))
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers[: len(codes)], out=self.sums[1:])

    def of(self, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
        return (self.sums[starts + sizes] - self.sums[starts]) * self.back[starts]

    def every(self, size: int) -> np.ndarray:
        """Of the windows of one size from each character on that has them."""
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.back[:n]


@cache
def powers_to(log: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number from the one with exponent 0 on, and those of its inverse."""
    steps = [np.full(1 << log, x, np.uint64) for x in (BASE, pow(BASE, -1, 1 << 64))]
    for s in steps:
        s[0] = 1
    return np.cumprod(steps[0], dtype=np.uint64), np.cumprod(steps[1], dtype=np.uint64)


def places(hashes: np.ndarray, salt: np.ndarray | int, log: int) -> np.ndarray:
    """The bits of a table of 2**log that stand for hashes; beginnings of 2**k characters have the salt k + 1, whole quotations 0."""
    x = (hashes + np.uint64(SALT) * np.asarray(salt, np.uint64)) * SPREAD
    x ^= x >> HALF
    return (x * SPREAD) >> np.uint64(64 - log)


def marked(log: int):  # noqa: ANN201  a function over Arrow batches of quotations
    """The bits of the table for whole quotations, and for the longest beginning of each with a power of 2 of characters."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = [t for t in batch.column(0).to_pylist() if t]
            groups = np.cumsum([len(t) for t in texts], dtype=np.int64) // SPAN_CHARS
            for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(groups)) + 1) if texts else []:
                group = [texts[k] for k in some]
                sizes = np.array([len(t) for t in group])
                starts, levels = np.cumsum(sizes) - sizes, np.frexp(sizes)[1] - 1
                own = Hashes("".join(group))
                bits = np.unique(np.concatenate([places(own.of(starts, sizes), 0, log), places(own.of(starts, 1 << levels), levels + 1, log)]))
                word, first = np.unique(bits >> np.uint64(6), return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(np.bitwise_or.reduceat(ONE << (bits & np.uint64(63)), first).view(np.int64))], ["word", "bits"])

    return run


def windows(shared, log: int, sizes: list[int]):  # noqa: ANN001, ANN201  a broadcast table; a function over Arrow batches of sources
    """The windows of texts that the table takes for quotations: all that are, and few others."""
    by_level: dict[int, list[int]] = {}
    for n in sizes:
        by_level.setdefault(n.bit_length() - 1, []).append(n)
    blank, longest = bool(by_level.pop(-1, None)), max(sizes)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        set_ = lambda bits: (table[bits >> np.uint64(6)] >> (bits & np.uint64(63)) & ONE).astype(bool)
        for batch in it:
            least: dict[str, object] = {}
            for group in spans(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), longest):
                text, ends = "".join(t for _, t in group), np.cumsum([len(t) for _, t in group])
                own, room = Hashes(text), np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(text))
                if blank:
                    least[""] = min(s for s in [least.get(""), *(s for s, _ in group)] if s is not None)
                for level, lengths in by_level.items():
                    if len(text) < 1 << level:
                        continue
                    begun = np.flatnonzero(set_(places(own.every(1 << level), level + 1, log)))
                    for n in lengths:
                        begun = begun[room[begun] >= n]  # lengths ascend
                        starts = begun[set_(places(own.of(begun, n), 0, log))]
                        for k, owner in zip(starts.tolist(), np.searchsorted(ends, starts, "right").tolist(), strict=True):
                            part, source = text[k : k + n], group[owner][0]
                            if part not in least or source < least[part]:
                                least[part] = source
            if least:
                yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.string()), pa.array(list(least.values()), batch.column(0).type)], ["quote", "source_id"])

    return run


def spans(rows: Iterable[tuple[object, str]], longest: int) -> Iterator[list[tuple[object, str]]]:
    """Texts with their sources in groups of about SPAN_CHARS; a longer text in parts that have every window of the longest size or less."""
    group, n = [], 0
    for source, text in rows:
        for at in range(0, max(1, len(text)), SPAN_CHARS):
            part = text if len(text) <= SPAN_CHARS else text[at : at + SPAN_CHARS + longest - 1]
            group.append((source, part))
            n += len(part)
            if n >= SPAN_CHARS:
                yield group
                group, n = [], 0
    if group:
        yield group
