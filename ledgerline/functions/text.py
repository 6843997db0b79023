"""Text functions: canonical form, quotation check, fuzzy ratios, citations, figures. Python ones take and give Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What is folded before quotations are compared. Fixed values.
QUOTE_MARKS = {"‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"'}
DASH_MARKS = "‐‑‒–—―−"
FOLD = str.maketrans({**QUOTE_MARKS, " ": " ", **{c: "-" for c in DASH_MARKS}})
ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
IMAGE_NAME = re.compile(r"\S+\.(?:jpg|jpeg|png|gif)\b", re.I)
IMAGE_END = re.compile(r"\.(?:jpg|jpeg|png|gif)\b", re.I)
#: Shortest quotation that is evidence, and the stray characters forgiven at its end. Fixed values.
SHORTEST, TAIL = 25, 3


def decoded(text: str) -> str:
    """Unicode escapes spelled out in the text become their characters."""
    return ESCAPE.sub(lambda m: chr(int(m[1], 16)), text)


def canonical(text: str) -> str:
    folded = decoded(text) if "\\u" in text else text
    if not folded.isascii():  # ASCII is its own normal form
        folded = unicodedata.normalize("NFKC", folded)
        for c, plain in FOLD.items():  # a text without the character costs next to nothing, a table costs the same for each character
            folded = folded.replace(chr(c), plain)
    if "." in folded and IMAGE_END.search(folded):
        folded = IMAGE_NAME.sub(" ", folded)
    return " ".join(folded.split()).lower()


@F.pandas_udf(T.StringType())
def canon_text(text: pd.Series) -> pd.Series:
    return text.map(canonical, na_action="ignore")


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the shorter text."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    ones = (1 << len(a)) - 1
    row = ones
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & ones
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 * (1 - insertions and deletions / total length)."""
    total = len(a) + len(b)
    return 200.0 * common_length(a, b) / total if total else 100.0


def token_sort(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.lower().split())), " ".join(sorted(b.lower().split())))


def token_set(a: str, b: str) -> float:
    """The best of: common words with each text's own ones against each other, and common words alone against either."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and not (left and right):
        return 100.0
    whole_x, whole_y = (f"{both} {s}".strip() for s in (left, right))
    edits = len(left) + len(right) - 2 * common_length(left, right)
    scores = [100.0 * (1 - edits / (len(whole_x) + len(whole_y)))]
    if both:
        scores += [100.0 * (1 - (len(s) + 1) / (len(both) + len(w))) for s, w in ((left, whole_x), (right, whole_y))]
    return max(scores)


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([np.nan if p is None or q is None else token_sort(p, q) for p, q in zip(a, b, strict=True)])


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([np.nan if p is None or q is None else token_set(canonical(p), canonical(q)) for p, q in zip(a, b, strict=True)])


def substantive_words(text: Column) -> Column:
    """Words of two ASCII letters or more, image file names aside."""
    return F.regexp_count(F.regexp_replace(text, r"[^ \t\n]+\.(jpg|jpeg|png|gif)", " "), F.lit("[A-Za-z]{2,}")).cast("bigint")


def items_in(text: Column, pattern: str) -> Column:
    """Distinct matches, sorted as text."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))


def short_id(prefix: str, year: Column, canonical_json: Column, digits: int = 8) -> Column:
    """PREFIX-FYyear-hash: the first hex digits of the SHA-256 of a canonical string."""
    return F.concat(F.lit(f"{prefix}-FY"), year.cast("string"), F.lit("-"), F.substring(F.sha2(canonical_json, 256), 1, digits))
