"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A text is
parsed greedily into the longest matches that occur in the sample; the language that needs fewest
phrases, normalised to bits a symbol (phrases * log2 of the sample's length / symbols), wins.

Greedy parsing with an automaton is itself deterministic: from a state, a symbol either prolongs the
match, or ends the phrase and starts the next at that symbol. So each automaton is flattened to one
table (state, symbol) -> state and phrases begun, and the texts of a batch are parsed side by side,
one symbol a step. Long texts are cut into blocks of BLOCK symbols, each parsed on its own, so every text is
parsed whole and no step waits for one long text.

Symbols are lower-case letters; everything else is one space, runs of which are one. The sample holds
SAMPLE_DOCS documents a language at most, those with the smallest hash of their id, SAMPLE_TEXT code points of each, and SAMPLE_CHARS
symbols. The driver builds the tables once and hands them out; workers only read them.

Defined cases: null texts and texts without a letter give `und` with score 0; without labelled text
every prediction is `und`; ties go to the language that comes first by name; rows with a null id are
predicted, never learned from, and count as not held out; repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import sub_batches, tune

SAMPLE_DOCS, SAMPLE_CHARS = 100, 32_768
#: Code points of one document's text in the sample at most, and the parts in which a language's documents are chosen.
SAMPLE_TEXT, SPREAD = 8_192, 64
BLOCK = 512
#: Bytes of text that are parsed side by side, unless one text alone has more.
TOGETHER = 2 << 20
UNKNOWN = "und"


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 for anything but letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(is_letter()[points], points, 0)


_LETTERS: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def squeezed(symbols: np.ndarray) -> np.ndarray:
    """Runs of zeros become one zero."""
    return symbols[np.r_[True, (symbols[1:] != 0) | (symbols[:-1] != 0)]] if len(symbols) else symbols


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The suffix automaton's transitions, built online; state 0 is the start."""
    nexts: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in symbols:
        now = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = now
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return nexts


class Model:
    """One parsing table a language. Entry: next state * 4 + phrases begun."""

    def __init__(self, samples: dict[str, str]) -> None:
        points = {lang: squeezed(letters_of(text))[:SAMPLE_CHARS] for lang, text in sorted(samples.items())}
        points = {lang: p for lang, p in points.items() if (p != 0).any()}
        self.langs = list(points)
        known = sorted(set().union(*(set(p.tolist()) for p in points.values())) - {0}) if points else []
        self.width = len(known) + 2
        self.symbol = np.where(is_letter(), self.width - 1, 0).astype(np.uint16)  # letters not in any sample have one symbol
        self.symbol[known] = np.arange(1, len(known) + 1)
        self.tables, self.bits = [], []
        for p in points.values():
            nexts = automaton(self.symbol[p].tolist())
            table = np.full((len(nexts), self.width), -1, np.int32)
            for state, to in enumerate(nexts):
                table[state, list(to)] = list(to.values())
            start = table[0]
            anew = np.where(start >= 0, start * 4 + 1, 1)  # a symbol not in the sample is a phrase of its own
            flat = np.where(table >= 0, table * 4, anew)
            flat[0] = anew
            self.tables.append(flat.astype(np.int32).ravel())
            self.bits.append(log2(max(len(p), 2)))

    def rates(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a symbol of every text in every language, and which texts have a letter."""
        n, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
        blocks, sizes, owner = [np.zeros((0, BLOCK), np.uint16)], [], []
        for i, t in enumerate(texts):
            s = squeezed(self.symbol[np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]) if t else ()
            if len(s):
                n[i], letters[i], k = len(s), bool((s != 0).any()), -(-len(s) // BLOCK)
                padded = np.zeros(k * BLOCK, np.uint16)
                padded[: len(s)] = s
                blocks.append(padded.reshape(k, BLOCK))
                sizes += [BLOCK] * (k - 1) + [len(s) - (k - 1) * BLOCK]
                owner += [i] * k
        order = np.argsort(-np.array(sizes, np.int64), kind="stable")
        grid = np.ascontiguousarray(np.concatenate(blocks)[order].T)
        longest_first, lanes = -np.array(sizes, np.int64)[order], np.array(owner, np.int64)[order]
        active = np.searchsorted(longest_first, -np.arange(BLOCK), "left")  # lanes longer than each step
        out = np.zeros((len(n), len(self.langs)))
        for k, table in enumerate(self.tables):
            state, begun = np.zeros(len(lanes), np.int32), np.zeros(len(lanes), np.int64)
            for step in range(BLOCK):
                m = int(active[step])
                if not m:
                    break
                got = table[state[:m] * np.int32(self.width) + grid[step, :m]]
                state[:m] = got >> 2
                begun[:m] += got & 3
            out[:, k] = np.bincount(lanes, begun, minlength=len(n)) * self.bits[k] / np.maximum(n, 1)
        return out, letters


def held_out(id_col: str) -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """A bounded sample of labelled text for each language, from documents that are not held out.

    The documents with the smallest hashes are chosen over narrow rows, first in SPREAD parts of a language (so that a language
    which most documents have is no single task's work), then among those; Spark drops the others before each exchange.
    Their texts, cut to SAMPLE_TEXT code points, come in one more scan.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("id is not null and lang is not null and text is not null and crc32(cast(id as string)) % 5 <> 0")
    order = [F.xxhash64("id"), F.col("id")]
    narrow = labelled.select("lang", "id").withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(SPREAD)))
    for keys in (["lang", "part"], ["lang"]):
        narrow = narrow.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= SAMPLE_DOCS).drop("place")
    wanted = [r[0] for r in narrow.select("id").distinct().collect()]  # SAMPLE_DOCS a language at most
    texts = labelled.where(F.col("id").isin(wanted)).select("lang", "id", F.substring("text", 1, SAMPLE_TEXT).alias("text"))
    samples: dict[str, str] = {}
    for r in sorted(texts.distinct().collect() if wanted else [], key=lambda r: (r["lang"], r["id"], r["text"])):
        if len(samples.get(r["lang"], "")) < 2 * SAMPLE_CHARS:
            samples[r["lang"]] = samples.get(r["lang"], "") + " " + r["text"]
    return samples


def predict(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, lang_pred, score (1 - best rate / second best) of every row; no shuffle."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return label(own, samples, ["id", "text"]).select(F.col("id").alias(id_col), "lang_pred", "score")


def label(docs: DataFrame, samples: dict[str, str], columns: list[str], text_col: str = "text") -> DataFrame:
    """The given columns of every row, and lang_pred and score; no shuffle."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Model(samples))  # 8 * SAMPLE_CHARS * distinct letters bytes a language at most
    source = docs.select(*columns)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it, text_col, TOGETHER):
            langs, scores = best(shared.value, batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*columns, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def best(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    rates, letters = model.rates(texts)
    langs, scores = [], []
    for row, has in zip(rates, letters, strict=True):
        if not has or not len(row):
            langs.append(UNKNOWN)
            scores.append(0.0)
            continue
        k = int(np.argmin(row))
        others = np.delete(row, k)
        langs.append(model.langs[k])
        scores.append(float(1 - row[k] / others.min()) if len(others) else 1.0)
    return langs, scores
