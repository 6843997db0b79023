"""Phrase collocation mining by hierarchical pair naming.

Texts become chunks: whole texts of one language, about CHUNK words, as one array of codes with the chunk's distinct words and their numbers
beside it. A level counts its candidates over all chunks (first words, then adjacent pairs), keeps those that occur often enough and names
each by the smallest place (chunk, code) where it stands, which no other candidate has. The names go back to the chunks that asked for them, not
to all: a chunk replaces its codes by names, and its adjacent names are the next level's candidates. A pair of (k-1)-grams
that overlap in k-2 words is a k-gram, and its two names are its parents: the counts of every cut and of every part follow from them.

Nothing is broadcast by this module or collected, and no task call holds more than a chunk (one text at least). Each candidate has one row for each
chunk that it stands in, so a word that is everywhere costs a row in CHUNK words.

Defined cases: null and empty texts have no words; a null language is `und`; repeated rows count as often as they stand; an empty table, or
a language without candidates, gives no rows; columns other than the two named ones are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import discard, lean, settle, shared_folder, sub_batches, tune

#: Words of a chunk, unless one text has more; words of all unfinished chunks of a task.
CHUNK, UNFINISHED = 1 << 22, 1 << 23
#: A place is partition, chunk of the partition, code: 20, 13 and 30 bits.
CHUNK_BITS, CODE_BITS = 13, 30
#: Rows of a batch of candidates.
ROWS = 1 << 16
#: Parts into which a language's phrases are dealt for the first cut of the ranking.
SPREAD = 64
#: Pieces end at [.,;:!?] and at LF, VT, FF, CR; words at space and tab. Fixed values.
PIECE_ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Upper-case ASCII letters to lower case, gaps to spaces, ends of pieces to LF.
_PLAIN = bytes(10 if c in PIECE_ENDS else 32 if c in GAPS else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Chunks are wide rows: the writer looks at its memory after each of them.
ROW_BY_ROW = {"compression": "zstd", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1"}


class Unfinished:
    """A chunk in the making: codes of words in order of first use, from 1; 0 ends a piece."""

    def __init__(self) -> None:
        self.code: defaultdict[bytes, int] = defaultdict()
        self.code.default_factory = self.code.__len__
        self.code[b"\n"], self.code[b""] = 0, 1
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        words = text.translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter(map(self.code.__getitem__, words), np.int32, len(words))
        codes = codes[codes != 1]
        self.parts += [codes, np.zeros(1, np.int32)]
        self.size += len(codes) + 1

    def row(self) -> tuple[bytes, list[bytes], np.ndarray]:
        """Packed codes from 0, words, their numbers."""
        codes, words = np.concatenate(self.parts) - 2, list(self.code)[2:]
        return packed(codes, len(words)), words, np.bincount(codes[codes >= 0], minlength=len(words))


def packed(codes: np.ndarray, n: int) -> bytes:
    """Codes below n, and n for a negative one, in the fewest bytes; one such place keeps apart what many did."""
    codes = codes[(codes >= 0) | np.r_[True, codes[:-1] >= 0]] if len(codes) else codes
    return np.where(codes < 0, n, codes).astype(np.uint16 if n < 1 << 16 else np.uint32).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if n < 1 << 16 else np.uint32)


def pairs_of(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether each place and the next have a code, the pair of each that does, and the distinct pairs: left, right, number; always in the same order."""
    at = unpacked(data, n).astype(np.int64)
    both = (at[:-1] < n) & (at[1:] < n)
    pairs, inverse, number = np.unique(at[:-1][both] * n + at[1:][both], return_inverse=True, return_counts=True)
    return both, inverse, pairs // max(n, 1), pairs % max(n, 1), number


def chunks(docs: DataFrame, text_col: str, lang_col: str, chunk_words: int) -> DataFrame:
    """chunk, lang, codes, items (distinct words), n (their numbers)."""
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text")).where("length(text) > 0")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, at_work = TaskContext.get().partitionId() << CHUNK_BITS, 0, {}

        def finish(lang: str) -> pa.RecordBatch:
            nonlocal made
            if made >> CHUNK_BITS:
                raise ValueError("a partition of more than 8192 chunks: read smaller partitions")
            codes, words, n = at_work.pop(lang).row()
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([first + made - 1]), pa.array([lang]), pa.array([codes]), pa.array([words], pa.list_(pa.binary())), pa.array([n], pa.list_(pa.int64()))], ["chunk", "lang", "codes", "items", "n"])

        for batch in sub_batches(it):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                at_work.setdefault(lang, Unfinished()).add(text.as_py())
                if at_work[lang].size >= chunk_words:
                    yield finish(lang)
            while sum(c.size for c in at_work.values()) > UNFINISHED:
                yield finish(max(at_work, key=lambda x: at_work[x].size))
        for lang in list(at_work):
            yield finish(lang)

    return source.mapInArrow(run, "chunk bigint, lang string, codes binary, items array<binary>, n array<bigint>")


def renamed(size: int) -> Callable[[tuple[pa.Scalar, ...], pa.Table, pa.Table], pa.Table]:
    """A function over one chunk and the names of its words (size 1) or pairs: the chunk in the codes of those names. Empty if no two names are adjacent."""
    out = pa.schema([("chunk", pa.int64()), ("codes", pa.binary()), ("names", pa.list_(pa.int64()))])

    def run(key: tuple[pa.Scalar, ...], chunk: pa.Table, found: pa.Table) -> pa.Table:
        if not chunk.num_rows or not found.num_rows:
            return out.empty_table()
        code, names, n, data = found["code"].to_numpy(), found["name"].to_numpy(), chunk["size"][0].as_py(), chunk["codes"][0].as_py()
        if size == 1:
            at, n_codes = unpacked(data, n), n + 1
        else:
            both, inverse, left, *_ = pairs_of(data, n)
            at, n_codes = np.full(len(both), len(left)), len(left) + 1
            at[both] = inverse
        local = np.full(n_codes, -1, np.int64)
        local[code] = np.arange(len(code))
        at = local[at]
        if not ((at[:-1] >= 0) & (at[1:] >= 0)).any():
            return out.empty_table()
        return pa.table([[key[0].as_py()], [packed(at, len(names))], [names]], schema=out)

    return run


def candidates(now: DataFrame) -> DataFrame:
    """chunk, code, left, right, n: the distinct adjacent pairs of names of each chunk."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in it:
            for chunk, data, names in zip(batch.column("chunk").to_pylist(), batch.column("codes"), batch.column("names"), strict=True):
                name = names.values.to_numpy()
                _, _, left, right, n = pairs_of(data.as_py(), len(name))
                for at in range(0, len(n), ROWS):
                    part = slice(at, at + ROWS)
                    size = len(n[part])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(size, chunk)), pa.array(np.arange(at, at + size)), pa.array(name[left[part]]), pa.array(name[right[part]]), pa.array(n[part])], ["chunk", "code", "left", "right", "n"])

    return now.select("chunk", "codes", "names").mapInArrow(run, "chunk bigint, code bigint, left bigint, right bigint, n bigint")


def named(found: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Of candidates (chunk, code, n, keys): those with n of `least` or more in all, and their name; where it is from, also the keys and the sum a."""
    alike = Window.partitionBy(*keys)
    placed = found.select((F.shiftleft("chunk", CODE_BITS) + F.col("code")).alias("place"), "n", *keys)
    both = placed.select("place", *keys, F.sum("n").over(alike).alias("a"), F.min("place").over(alike).alias("name")).where(F.col("a") >= least)
    once = F.col("place") == F.col("name")
    return both.select(F.shiftright("place", CODE_BITS).alias("chunk"), F.col("place").bitwiseAND((1 << CODE_BITS) - 1).alias("code"), "name", *(F.when(once, F.col(c)).alias(c) for c in [*keys, "a"]))


def once(found: DataFrame) -> DataFrame:
    """One row for each name."""
    return found.where("a is not null")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)), in decimals of 38 digits."""
    return F.call_function("div", a.cast("decimal(19,0)") * F.lit(2000000), left.cast("decimal(19,0)") + right.cast("decimal(19,0)"))


def scored(entries: DataFrame, longer: DataFrame | None, size: int, cover: int) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates of `size` words that no longer one covers: by the cut with the lowest score, the first of equal ones."""
    if longer is not None:
        above = longer.select(F.explode(F.array_distinct(F.array("left", "right"))).alias("name"), "a").groupBy("name").agg(F.max("a").alias("above"))
        entries = entries.join(above, "name", "left").where(F.expr(f"above is null or cast(100 as decimal(19,0)) * above < cast({cover} as decimal(19,0)) * a"))
    cuts = [F.struct(score(F.col("a"), F.col("starts")[k - 1], F.col("ends")[size - k - 1]).alias("score"), F.lit(k).alias("k"), F.col("starts")[k - 1].alias("l"), F.col("ends")[size - k - 1].alias("r")) for k in range(1, size)]
    lowest = entries.withColumn("cut", F.array_min(F.array(*cuts)))
    return lowest.select("lang", F.array_join(F.transform("words", lambda w: w.cast("string")), " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, cover: int = 80, longest: int = 4, top: int = 2000, chunk_words: int = CHUNK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language, of 2 to `longest` words that occur `least` times or more.

    A phrase is left out if a longer candidate holds it and has `cover` % of its occurrences (it is enough to look one word further: the occurrences of a
    phrase never grow with its length). Order: score and a descending, phrase ascending.
    """
    spark = docs.sparkSession
    tune(spark)
    folder = shared_folder(spark)

    def step(df: DataFrame, name: str, **options: str) -> DataFrame:
        spark.sparkContext._jvm.System.gc()  # nothing refers to the step before any more, so its shuffle files go
        return settle(df, name, folder, **options)

    now = step(chunks(docs, text_col, lang_col, chunk_words), "chunks1", **ROW_BY_ROW)
    totals = step(now.groupBy("lang").agg(F.sum(F.aggregate("n", F.lit(0).cast("bigint"), lambda x, y: x + y)).alias("n")), "totals")
    words = now.select("chunk", "lang", F.posexplode(F.arrays_zip("items", "n")).alias("code", "e")).select("chunk", "lang", "code", F.col("e.items").alias("item"), F.col("e.n").alias("n"))
    found = step(named(words, ["lang", "item"], least), "names1")
    entries = [once(found).select("name", "lang", "a", F.array("item").alias("words"), F.array("a").alias("starts"), F.array("a").alias("ends"))]
    pairs: list[DataFrame] = []
    now = now.select("chunk", "codes", F.size("items").alias("size"))
    for size in range(2, longest + 1):
        asked = found.select("chunk", "code", "name").groupBy("chunk")
        now = step(now.groupBy("chunk").cogroup(asked).applyInArrow(renamed(size - 1), "chunk bigint, codes binary, names array<bigint>"), f"chunks{size}", **ROW_BY_ROW)
        discard(spark, f"{folder}/chunks{size - 1}")
        found = step(named(candidates(now), ["left", "right"], least), f"names{size}")
        now = now.select("chunk", "codes", F.size("names").alias("size"))
        pairs.append(once(found).select("name", "left", "right", "a"))
        first = entries[-1].select(F.col("name").alias("left"), "lang", F.col("words").alias("front"), F.col("starts").alias("before"))
        last = entries[-1].select(F.col("name").alias("right"), F.element_at("words", -1).alias("word"), F.col("ends").alias("after"))
        both = pairs[-1].join(first, "left").join(last, "right")
        entries.append(step(both.select("name", "lang", "a", F.array_append("front", F.col("word")).alias("words"), F.array_append("before", F.col("a")).alias("starts"), F.array_append("after", F.col("a")).alias("ends")), f"entries{size}"))
    discard(spark, f"{folder}/chunks{longest}")
    parts = [scored(entries[k], pairs[k] if k < len(pairs) else None, k + 1, cover) for k in range(1, longest)]
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.union(part)
    ranked = ranked.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    for keys in (["lang", "part"], ["lang"]):
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals.hint("merge"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
