"""Word shingles as 64-bit hashes, computed for whole batches without a loop over words.

Words are the runs of bytes outside space, tab, LF, VT, FF and CR, with A-Z lower-cased. A text's
set holds its distinct shingles of K words; with fewer words the whole sequence is the one shingle;
without words, or null, the set is empty. A word's hash is a polynomial over random numbers for its
bytes, taken from running sums by the inverse of the power at its start (the base is odd, so it has
one modulo 2^64). Two different shingles share a hash with probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

K = 5
#: Bytes of text that are hashed together, unless one text alone has more.
TOGETHER = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
#: White space of the word contracts. Fixed values.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.array([xxhash.xxh3_64_intdigest(bytes([b]).lower(), seed=11) for b in range(256)], np.uint64)
_POWERS: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base, and of its inverse. Kept as far as asked for, up to the length of a usual group; one long text's are made for it alone."""
    usual = TOGETHER + (TOGETHER >> 3)
    if n > usual:
        return [_powers_of(base, n) for base in (_BASE, pow(_BASE, -1, 1 << 64))]
    if len(_POWERS[0]) < n:
        _POWERS[:] = [_powers_of(base, min(usual, 1 << n.bit_length())) for base in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS


def _powers_of(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[0] = 1
    return np.multiply.accumulate(x, out=x)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a hash depends on all of its input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts in order, and how many words each text has."""
    buffer = b"\n" + b"\n".join(raws) + b"\n"
    data = np.frombuffer(buffer, np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    power, inverse = powers(len(data))
    running = np.cumsum(_BYTE[data] * power[: len(data)], dtype=np.uint64)
    h = mixed((running[ends - 1] - running[starts - 1]) * inverse[starts] + (ends - starts).astype(np.uint64))
    borders = np.cumsum([1, *(len(r) + 1 for r in raws)])
    return h, np.diff(np.searchsorted(starts, borders))


def grouped(texts: list[str | None]) -> Iterator[list[bytes]]:
    group: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        group.append(raw)
        size += len(raw)
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def rows_of(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the hashes of its shingles in text order, repeats included."""
    return [s for group in grouped(texts) for s in _rows(*word_hashes(group))]


def word_counts(texts: list[str | None]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(word_hashes(group)[1] for group in grouped(texts))])


def runs_of(texts: list[str | None], lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each of the lengths (under K): which text, and the hash, of every run of so many words; a text of so many words has that shingle."""
    first = 0
    for group in grouped(texts):
        flat, counts = word_hashes(group)
        text = np.repeat(np.arange(len(counts)), counts)
        for k in lengths:
            n = max(len(flat) - k + 1, 0)
            h = np.zeros(n, np.uint64)
            for j in range(k if n else 0):
                h = h * _MULTIPLIER + flat[j : n + j]
            whole = text[:n] == text[k - 1 :][:n]
            yield k, text[:n][whole] + first, mixed(h[whole] + np.uint64(k))
        first += len(group)


def weighed_rows(texts: list[str | None], words: np.ndarray, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its shingles, and for each of them the sum of its words' weights; `words` are sorted hashes, others weigh 0."""
    for group in grouped(texts):
        flat, counts = word_hashes(group)
        at = np.minimum(np.searchsorted(words, flat), max(len(words) - 1, 0))
        own = np.where(words[at] == flat, weights[at], 0) if len(words) else np.zeros(len(flat), np.int64)
        total = np.r_[0, np.cumsum(own)]
        begin = np.cumsum(counts) - counts
        for row, a, n in zip(_rows(flat, counts), begin.tolist(), counts.tolist(), strict=True):
            k = min(K, n)
            yield row, total[a + k : a + n + 1] - total[a : a + n + 1 - k] if n else own[:0]


def _rows(flat: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    n_rolled = max(len(flat) - K + 1, 0)
    rolled = flat[:n_rolled].copy()
    for k in range(1, K if n_rolled else 0):
        rolled = rolled * _MULTIPLIER + flat[k : n_rolled + k]
    rolled = mixed(rolled + np.uint64(K))
    out, at = [], 0
    for n in counts.tolist():
        if n >= K:
            out.append(rolled[at : at + n - K + 1])
        elif n:
            h = np.zeros(1, np.uint64)
            for x in flat[at : at + n]:
                h = h * _MULTIPLIER + x
            out.append(mixed(h + np.uint64(n)))
        else:
            out.append(flat[:0])
        at += n
    return out


def sets_of(texts: list[str | None]) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    return [np.unique(r) for r in rows_of(texts)]
