"""Rolling window features of text lengths: counts, sums, distinct languages, order statistics of the rows before each row.

Rows are collapsed first to (group, time, length, language, number), so copies and bursts cost what their distinct values do. The
times of a group are cut into slices as long as the longest window; a collapsed row goes to its own slice and to the next one, if
a window there can reach it. One task call holds one slice and its look-back, never a group: a group of any size is as many calls as
it has slices, and a call's rows are bounded by the times and distinct lengths and languages of two windows, whatever the number of
rows. Within it, a wavelet matrix over the lengths in time order answers all order statistics at once.

Defined cases: a null group is a group of its own; a null time (a null id) has empty windows and is in none; a null text has no length and still counts
as an event; an empty text has length 0; repeated rows each count and each get their rows; an empty table gives an empty one. Columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import tune

#: Windows of the registered query, seconds.
WINDOWS = (3600, 21600)
MEASURES = ["n_events", "sum_chars", "n_langs", "median_chars", "high_chars"]


class WaveletMatrix:
    """Weighted values, most significant bit first: at each bit plane the prefix number and the prefix weight of zero bits."""

    def __init__(self, values: np.ndarray, weights: np.ndarray):
        self.planes = []
        for bit in reversed(range(int(values.max()).bit_length() if len(values) else 0)):
            zero = (values >> bit) & 1 == 0
            self.planes.append((bit, np.r_[0, np.cumsum(zero)].astype(np.int32), np.r_[0, np.cumsum(np.where(zero, weights, 0))]))
            order = np.r_[np.flatnonzero(zero), np.flatnonzero(~zero)]
            values, weights = values[order], weights[order]

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 1, by weight) of places lo to hi of each query; a query with a k beyond its weight means nothing."""
        out = np.zeros(len(k), np.int64)
        for bit, zeros, weight in self.planes:
            below = weight[hi] - weight[lo]
            right = k > below
            k = np.where(right, k - below, k)
            out |= right.astype(np.int64) << bit
            lo, hi = (np.where(right, x - zeros[x] + zeros[-1], zeros[x]) for x in (lo, hi))
        return out


def event_time(id_col: str = "doc_id") -> Column:
    """60 * floor((id + crc32(id) mod 4000) / 6), seconds, exact; null where the id is no integer or the time has more than 64 bits."""
    moved = F.col(id_col).try_cast("decimal(20,0)") + F.crc32(F.col(id_col).cast("string")) % 4000
    return ((moved - F.pmod(moved, F.lit(6))) / 6 * 60).try_cast("bigint")


def start_of(time: Column, width: int) -> Column:
    """The start of the slice that holds a time."""
    return time - F.pmod(time, F.lit(width))


def features(start: int, width: int, windows: Sequence[int], t: np.ndarray, length: np.ndarray, known: np.ndarray, lang: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The distinct times of one slice and, for each window, the five MEASURES at each; medians of windows without lengths are -1.

    Collapsed rows: time, length, whether it is known, language (from 0, -1: none), number of rows. `start` and `width` are the slice's.
    """
    order = np.argsort(t, kind="stable")
    t, length, known, lang, n = t[order], length[order], known[order], lang[order], n[order]
    times, at = np.unique(t, return_inverse=True)
    asked = times[(times >= start) & (times < start + width)]
    events = np.r_[0, np.cumsum(n)]
    t_known, w = t[known], n[known]
    known_rows, chars = np.r_[0, np.cumsum(w)], np.r_[0, np.cumsum(w * length[known])]
    matrix = WaveletMatrix(length[known], w)
    out = []
    for window in windows:
        lo, hi = np.searchsorted(t, asked - window, "left"), np.searchsorted(t, asked, "left")
        first, last = np.searchsorted(times, asked - window, "left"), np.searchsorted(times, asked, "left")
        n_langs = np.zeros(len(asked), np.int64)
        for code in np.unique(lang[lang >= 0]):  # one prefix count at a time, so memory doesn't grow with the number of languages
            seen = np.r_[0, np.cumsum(np.bincount(at[lang == code], minlength=len(times)))]
            n_langs += seen[last] > seen[first]
        a, b = np.searchsorted(t_known, asked - window, "left"), np.searchsorted(t_known, asked, "left")
        m = known_rows[b] - known_rows[a]
        ranks = [matrix.kth(a, b, np.where(m > 0, (share * m + 99) // 100, 1)) for share in (50, 75)]
        out.append([events[hi] - events[lo], chars[b] - chars[a], n_langs, *(np.where(m > 0, r, -1) for r in ranks)])
    return asked, out


def rolling_features(docs: DataFrame, time: Column, windows: Sequence[int] = WINDOWS, group_col: str = "source", id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """For each row and each window W: `id_col`, window_s, event_s and MEASURES over the group's rows with event_s - W <= time < event_s.

    `time`: a bigint column over `docs`. median_chars and high_chars: the lengths numbered ceil(m/2) and ceil(75*m/100) of m in ascending order.
    """
    tune(docs.sparkSession)
    width = max(windows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).cast("string").alias("grp"), time.alias("t"), F.length(F.col(text_col).cast("string")).cast("bigint").alias("length"), F.col(lang_col).cast("string").alias("lang"))
    timed = rows.where("t is not null").groupBy("grp", "t", "length", "lang").agg(F.count("*").alias("n"))
    slices = timed.withColumn("start", F.explode(F.sequence(start_of(F.col("t"), width), start_of(F.col("t") + width, width), F.lit(width))))
    fields = pa.struct([("window_s", pa.int64()), *((name, pa.int64()) for name in MEASURES)])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        known = table["length"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        codes = table["lang"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        asked, found = features(key[1].as_py(), width, windows, table["t"].to_numpy(), table["length"].combine_chunks().fill_null(0).to_numpy(), known, codes, table["n"].to_numpy())
        columns = [np.stack([np.full(len(asked), w) for w in windows], 1).ravel(), *(np.stack([f[k] for f in found], 1).ravel() for k in range(len(MEASURES)))]
        arrays = [pa.array(x, pa.int64(), mask=x < 0 if name in MEASURES[3:] else None) for x, name in zip(columns, ["window_s", *MEASURES], strict=True)]
        offsets = pa.array(np.arange(len(asked) + 1) * len(windows), pa.int32())
        each = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(arrays, fields=list(fields)))
        return pa.table({"g": pa.array([key[0].as_py()] * len(asked), pa.string()), "event": pa.array(asked, pa.int64()), "each": each})

    kind = ", ".join(f"{name}: bigint" for name in ["window_s", *MEASURES])
    known_at = slices.groupBy("grp", "start").applyInArrow(run, f"g string, event bigint, each array<struct<{kind}>>")
    none = F.array(*(F.struct(F.lit(w).cast("bigint").alias("window_s"), *(F.lit(0 if k < 3 else None).cast("bigint").alias(name) for k, name in enumerate(MEASURES))) for w in windows))
    joined = rows.select("id", "grp", "t").join(known_at.hint("merge"), F.col("grp").eqNullSafe(F.col("g")) & (F.col("t") == F.col("event")), "left")
    return joined.select("id", F.col("t").alias("event_s"), F.inline(F.coalesce("each", none))).select(F.col("id").alias(id_col), "window_s", "event_s", *MEASURES)
