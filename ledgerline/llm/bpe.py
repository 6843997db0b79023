"""BPE encoding and decoding by batched numpy merge rounds.

The texts of a batch are normalised and laid out as one array of code points; character classes give
the borders of all pre-tokens at once, and running sums a 64-bit hash of each. Pre-tokens not met
before (by hash, in an open-addressing table) are merged together, their symbols in one flat array:
each round finds the rank of every adjacent pair by binary search over the sorted pair keys, takes
each word's lowest rank, merges that pair at all its places (left to right), and lets finished words
leave the array. Words of over LONG symbols, for which rounds would cost the square of the length,
are merged with a heap instead. Two different pre-tokens share a hash with probability of about 2^-64.

Results equal those of the `tokenizers` library for files of this kind (NFC, white space to one
space, lower case; split into contractions, letter runs, single digits and other runs; byte-level
symbols with an end-of-word suffix), without added special tokens. Special strings in a text are
matched before normalisation, as the library does by default.

Defined cases: a null or empty text has no ids and decodes to the empty string; a null list of ids
decodes to the empty string; ids outside the vocabulary are left out, as the library does; repeated
rows each give their own row.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import give_back, held, sub_batches, tune
from ledgerline.llm.shingles import mixed, powers

LONG = 512
#: Distinct pre-tokens that an encoder remembers; beyond it, it starts anew.
REMEMBERED = 700_000
#: White space of the vocabulary file's engine, and the endings of its contractions. Fixed values.
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Character classes.
SPACE, LETTER, SINGLE, OTHER = range(4)
#: Special strings are code points from here on.
BEYOND = 0x110000


def classes() -> np.ndarray:
    """The class of every code point, and of some beyond for special strings."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(BEYOND)]
    out = np.array([LETTER if k == "L" else SINGLE if k == "N" else OTHER for k in kinds] + [SINGLE] * 256, np.uint8)
    out[list(WHITE)] = SPACE
    return out


def byte_letters() -> list[str]:
    """The printable stand-in for each byte value in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


class Vocabulary:
    """The tables of a tokenizer file."""

    def __init__(self, path: str) -> None:
        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        self.token = [None] * self.size
        for text, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = text
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.final = np.array([vocab[x + suffix] for x in letters], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], np.arange(len(merges))[order]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None


#: Code points that are laid out together, unless one text alone has more; a worker's memory has about a hundred bytes for each.
TOGETHER = 1 << 18


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, by running sums of a polynomial."""
    power, inverse = powers(len(points))
    value = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25)
    value ^= value >> np.uint64(32)
    running = np.cumsum(value * power[: len(points)], dtype=np.uint64)
    before = np.where(starts > 0, running[starts - 1], np.uint64(0))
    return mixed((running[ends - 1] - before) * inverse[starts] + (ends - starts).astype(np.uint64))


NEVER = np.iinfo(np.int64).max


def ranks(v: Vocabulary, pairs: np.ndarray) -> np.ndarray:
    """The merge rank of each pair key, by binary search; NEVER if it is no merge."""
    at = np.minimum(np.searchsorted(v.keys, pairs), len(v.keys) - 1)
    return np.where(v.keys[at] == pairs, v.rank[at], NEVER)


def merge_rounds(v: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all words of one flat array; returns the ids and how many each word has."""
    word = np.repeat(np.arange(len(lengths)), lengths)
    done_ids, done_words = [], []
    while len(symbols):
        rank = np.full(len(symbols), NEVER)
        same = np.flatnonzero(word[1:] == word[:-1])
        rank[same] = ranks(v, symbols[same] * v.size + symbols[same + 1])
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[starts, len(symbols)])
        least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        if not (active := least != NEVER).all():
            done_ids.append(symbols[~active])
            done_words.append(word[~active])
            symbols, word, rank, least = symbols[active], word[active], rank[active], least[active]
            if not len(symbols):
                break
        hit = rank == least
        at = np.flatnonzero(hit)
        if len(at) > 1 and (at[1:] == at[:-1] + 1).any():  # x x x: merge at the first, third, ... place of such a run
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            within = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
            at = at[within % 2 == 0]
        symbols[at] = v.made[rank[at]]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, word = symbols[stay], word[stay]
    ids = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
    words = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
    return ids[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(lengths))


def merge_heap(v: Vocabulary, symbols: list[int]) -> list[int]:
    """The same merges for one long word, in n log n steps."""
    n = len(symbols)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    first = ranks(v, np.array(symbols[:-1], np.int64) * v.size + np.array(symbols[1:], np.int64)).tolist()
    heap = [(r, i, symbols[i], symbols[i + 1]) for i, r in enumerate(first) if r != NEVER]
    heapq.heapify(heap)
    known = dict(zip(v.keys.tolist(), v.rank.tolist(), strict=True))
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j < 0 or symbols[j] != b:
            continue
        symbols[i], symbols[j] = int(v.made[r]), -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0 and (q := known.get(symbols[x] * v.size + symbols[y])) is not None:
                heapq.heappush(heap, (q, x, symbols[x], symbols[y]))
    return [s for s in symbols if s >= 0]


class Table:
    """64-bit hashes to codes 0, 1, 2, ... by open addressing, for whole arrays."""

    def __init__(self, most: int) -> None:
        size = 1 << (3 * most // 2).bit_length()
        self.room = most
        self.mask = np.uint64(size - 1)
        self.keys, self.codes, self.n = np.zeros(size, np.uint64), np.full(size, -1, np.int32), 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The code of each hash, -1 for those not met."""
        at = (h & self.mask).astype(np.int64)
        out = self.codes[at]
        wrong = np.flatnonzero((out >= 0) & (self.keys[at] != h))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & int(self.mask)
            out[wrong] = self.codes[at[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.keys[at[wrong]] != h[wrong])]
        return out

    def add(self, h: np.ndarray) -> None:
        """Give the next codes to distinct hashes not met before."""
        code = np.arange(self.n, self.n + len(h), dtype=np.int32)
        self.n += len(h)
        at = (h & self.mask).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            free = left[self.codes[at[left]] < 0]
            self.codes[at[free]] = code[free]  # of several for one place the last stays
            self.keys[at[free]] = h[free]
            left = left[self.codes[at[left]] != code[left]]
            at[left] = (at[left] + 1) & int(self.mask)


class Encoder:
    """Texts to ids, with a bounded memory of the pre-tokens met before."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.kind = classes()
        self.specials = list(v.special)
        self.table = None  # made by the first text: a worker that only decodes needs none

    def forget(self, room: int = 0) -> None:
        self.table = Table(max(REMEMBERED, room))
        self.flat = np.zeros(0, np.uint32)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def points(self, text: str) -> list[np.ndarray]:
        """Code points of the normalised text; a special string is one code point beyond the others."""
        parts = self.v.split.split(text) if any(s in text for s in self.specials) else [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.array([BEYOND + self.specials.index(part)], np.uint32))
            elif part:
                if not part.isascii():
                    part = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3")
                out.append(np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), np.uint32))
        return out

    def borders(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each pre-token begins and ends."""
        kind = self.kind[points]
        changes = np.r_[True, kind[1:] != kind[:-1]]
        begins = (changes | (kind == SINGLE)) & (kind != SPACE)
        quotes = np.flatnonzero((points == 39) & begins)
        for ending in CONTRACTIONS if len(quotes) else ():
            near = quotes[quotes + len(ending) < len(points)]
            for k, c in enumerate(ending):
                near = near[points[near + 1 + k] == ord(c)]
            begins[near + 1] = False
            follows = near + 1 + len(ending)
            follows = follows[follows < len(points)]
            begins[follows[kind[follows] == LETTER]] = True
        starts = np.flatnonzero(begins)
        stops = np.flatnonzero(begins | (changes & (kind == SPACE)))
        ends = np.r_[stops, len(points)][np.searchsorted(stops, starts, "right")] if len(starts) else starts
        return starts, ends

    def learn(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode distinct new pre-tokens and remember their ids."""
        n = ends - starts
        total = np.cumsum(n)
        own = points[np.repeat(starts - (total - n), n) + np.arange(total[-1])]
        first = total - n
        special = np.flatnonzero(own[first] >= BEYOND)
        names = own[first[special]] - BEYOND
        own[first[special]] = 32
        sizes = 1 + (own >= 0x80).astype(np.int64) + (own >= 0x800) + (own >= 0x10000)
        raw = own.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        ids, counts = self.words(np.frombuffer(raw, np.uint8), np.add.reduceat(sizes, first))
        begin = np.cumsum(counts) - counts
        for at, name in zip(special.tolist(), names.tolist(), strict=True):
            ids[begin[at]] = self.v.special[self.specials[name]]
        self.start = np.concatenate([self.start, len(self.flat) + begin])
        self.length = np.concatenate([self.length, counts.astype(np.int32)])
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])

    def words(self, buffer: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of pre-tokens given as UTF-8 bytes one after another."""
        symbols = self.v.inner[buffer]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.v.final[buffer[ends - 1]]
        long = np.flatnonzero(lengths > LONG)
        if not len(long):
            return merge_rounds(self.v, symbols, lengths)
        own = {int(i): merge_heap(self.v, symbols[ends[i] - lengths[i] : ends[i]].tolist()) for i in long}
        short = np.where(lengths > LONG, 0, lengths)
        ids, counts = merge_rounds(self.v, symbols[np.repeat(lengths <= LONG, lengths)], short)
        out, cut = [], np.r_[0, np.cumsum(counts)]
        last = 0
        for i in long.tolist():
            out += [ids[cut[last] : cut[i]], np.array(own[i], np.int64)]
            counts[i] = len(own[i])
            last = i
        return np.concatenate([*out, ids[cut[last] :]]), counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit integers, and how many each text has."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        group: list[str | None] = []
        size = 0
        for i, text in enumerate(texts):
            group.append(text)
            size += len(text or "")
            if size >= TOGETHER or i == len(texts) - 1:
                got, n = self.group(group)
                ids.append(got)
                counts.append(n)
                group, size = [], 0
        return np.concatenate(ids), np.concatenate(counts)

    def group(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        gap, parts, sizes = np.array([32], np.uint32), [], []
        for text in texts:
            own = [*(self.points(text) if text else ()), gap]
            parts += own
            sizes.append(sum(map(len, own)))
        points = np.concatenate(parts)
        starts, ends = self.borders(points)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if self.table is None:
            self.forget()
        h = span_hashes(points, starts, ends)
        code = self.table.find(h)
        if len(new := np.flatnonzero(code < 0)):
            distinct, at = np.unique(h[new], return_index=True)
            if self.table.n + len(distinct) > self.table.room:
                distinct, at = np.unique(h, return_index=True)
                new = np.arange(len(h))
                self.forget(len(distinct))
            self.table.add(distinct)
            self.learn(points, starts[new[at]], ends[new[at]])
            code = self.table.find(h)
        n = self.length[code].astype(np.int64)
        total = np.r_[0, np.cumsum(n)]
        ids = self.flat[np.repeat(self.start[code] - total[:-1], n) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(starts, np.r_[0, np.cumsum(sizes)])])


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""

    def make() -> Encoder:
        e = Encoder(Vocabulary(path))
        give_back()  # what reading the file took
        return e

    return held(("bpe", path), make)


def decode_ids(v: Vocabulary, ids: np.ndarray) -> str:
    """The tokens with one space between them: the file has no decoder, so the library joins them so."""
    token, size = v.token, v.size
    return " ".join([t for i in ids.tolist() if i < size and (t := token[i]) is not None])


def with_ids(batch: pa.RecordBatch, path: str) -> pa.RecordBatch:
    """id, n_tokens and ids of a batch of id and text. For workers."""
    ids, counts = encoder(path).encode(batch.column("text").to_pylist())
    cut, raw = np.r_[0, np.cumsum(counts)] * 4, ids.tobytes()
    return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array([raw[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], pa.binary())], ["id", "n_tokens", "ids"])


def with_decoded(batch: pa.RecordBatch, path: str) -> pa.RecordBatch:
    """The batch and the decoded text of its ids. For workers."""
    v = encoder(path).v
    texts = [decode_ids(v, np.frombuffer(b or b"", "<u4")) for b in batch.column("ids").to_pylist()]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, n_tokens (long) and ids (binary, little-endian unsigned 32-bit) of every text; no shuffle."""
    tune(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it, keep=("bpe", path)):
            yield with_ids(batch, path)

    return source.mapInArrow(run, f"id {id_type}, n_tokens bigint, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """`id_col`, n_tokens, ids and decoded (string) of every row of encode()."""
    tune(encoded.sparkSession)
    source = encoded.select(F.col(id_col).alias("id"), "n_tokens", "ids")
    id_type = source.schema["id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it, "ids", keep=("bpe", path)):
            yield with_decoded(batch, path)

    return source.mapInArrow(run, f"id {id_type}, n_tokens bigint, ids binary, decoded string").withColumnRenamed("id", id_col)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """decode() of encode(), in one Python worker for each task: one after the other, they take two, each with the vocabulary."""
    tune(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(it, keep=("bpe", path)):
            yield with_decoded(with_ids(batch, path), path)

    return source.mapInArrow(run, f"id {id_type}, n_tokens bigint, ids binary, decoded string").withColumnRenamed("id", id_col)
