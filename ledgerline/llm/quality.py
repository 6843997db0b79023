"""Quality rules: hashed n-gram log-likelihood ratio against trusted documents, by built-in functions only.

The n-grams of a text are its words, its pairs of neighbouring words and, as words are an open set, the last three characters of
each word; each hashed to one of BUCKETS. Over all documents the raw multinomial is counted, over TRUSTED labelled documents at
most (those of the smallest hash of their id) the target one; a document's score is the mean over its n-grams of
log target - log raw, and it is kept if that is at least THRESHOLD and it did not fail the base rules.

Base rules: see `features`. A word is a run of characters outside space, tab, LF, VT, FF and CR. Windows of three words are
compared by 64-bit hash, so two different ones are taken for equal with probability 2^-64.

Counting explodes n-grams into a map-side aggregate of BUCKETS rows, so only that table is shuffled; it is
a bounded array in the second pass. Without trusted documents all ratios are 0.

Defined cases: null or empty texts have zeros everywhere and fail the base rules; repeated rows each give a row; null ids are scored and
never trusted; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 65_536
TRUSTED = 20_000
SMOOTHING = 0.5
THRESHOLD = -0.35
#: White space and symbols of the contract. Fixed values.
SPACES, SYMBOLS = r"[ \t\n\x0B\f\r]+", r"[#*$%&|<>]"


def bound(value: Column, body) -> Column:
    """`body(value)` with the value computed once: a lambda's variable is never inlined."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def repeated_words(ws: Column) -> Column:
    """Words that lie in three-word windows which occur twice or more, each counted once."""
    windows = F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))

    def places(s: Column) -> Column:
        same = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda e, i: same(e, i - 1) | same(e, i + 1)), lambda e: e["at"]))

    def covered(p: Column) -> Column:
        spans = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)

    def of(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(bound(bound(pairs, places), covered))

    return bound(windows, of)


def n_grams(ws: Column) -> Column:
    """The bucket of each word, then of each pair of neighbours, then of each word's ending."""
    bucket = lambda *c: F.pmod(F.xxhash64(*c), F.lit(BUCKETS)).cast("int")
    pairs = F.transform(F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: bucket(F.get(ws, i), w))
    return F.concat(F.transform(ws, lambda w: bucket(w)), pairs, F.transform(ws, lambda w: bucket(F.right(w, F.lit(3)), F.lit(3))))


def features(text: Column, score: Callable[[Column], Column]) -> list[Column]:
    """parts (n_words, word_chars: code points in words, n_repeat_words, score of the words), n_symbols, n_dup_lines (lines with a word equal to an earlier line)."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    parts = bound(words(text), lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), F.length(F.array_join(ws, "")).cast("long").alias("word_chars"), repeated_words(ws).alias("n_repeat_words"), score(ws).alias("score")))
    dup = bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return [parts.alias("parts"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), dup.alias("n_dup_lines")]


def ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log target - log raw of each bucket; docs (id, text), labels (id) of trusted documents."""
    trusted = labels.where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(TRUSTED).withColumn("good", F.lit(1))
    flagged = docs.join(F.broadcast(trusted), "id", "left")  # at most TRUSTED rows
    grams = flagged.select(F.explode(bound(words(F.col("text")), n_grams)).alias("bucket"), F.coalesce("good", F.lit(0)).alias("good"))
    rows = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("target")).collect()  # at most BUCKETS
    n_raw, n_target = sum(r["raw"] for r in rows), sum(r["target"] for r in rows)
    if not n_target:
        return [0.0] * BUCKETS
    out = [log(SMOOTHING / (n_target + SMOOTHING * BUCKETS)) - log(SMOOTHING / (n_raw + SMOOTHING * BUCKETS))] * BUCKETS
    for r in rows:
        out[r["bucket"]] = log((r["target"] + SMOOTHING) / (n_target + SMOOTHING * BUCKETS)) - log((r["raw"] + SMOOTHING) / (n_raw + SMOOTHING * BUCKETS))
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """`id_col`, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept of every row."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    good = labels.where(F.col(label_col) == 1).select(F.col(label_id_col).alias("id"))
    table = F.split(F.lit(",".join(f"{x:.9g}" for x in ratios(source, good))), ",").cast("array<double>")  # folded to one constant
    total = lambda gs: F.when(F.size(gs) > 0, F.aggregate(gs, F.lit(0.0), lambda a, g: a + F.get(table, g)) / F.size(gs)).otherwise(F.lit(0.0))
    rated = source.select("id", *features(F.col("text"), lambda ws: bound(n_grams(ws), total)))  # one split of each text
    counted = rated.select(F.col("id").alias(id_col), F.col("parts.n_words"), F.col("parts.word_chars"), "n_symbols", "n_dup_lines", F.col("parts.n_repeat_words"), F.col("parts.score"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= THRESHOLD))
