"""Quotations against their sources: one canonical form with a map back to the raw text, and one search on it.

A quotation is folded once, character by character, together with the raw place each canonical character comes from, and a source as a
whole. The quotation is then looked for as a whole; failing that, the longest beginning that the source has decides. So the verified span
is cut from the raw quotation by the map, and nothing is folded twice.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import ESCAPE, FOLD, IMAGE_NAME, SHORTEST, TAIL, canonical

#: The part of a quotation that has to agree for it to count as altered rather than absent. Fixed value.
NEAR = 0.25
#: Characters before a mark that it can compose with, beyond which a pile of marks is no letter.
MOST_MARKS = 32


class Canonical:
    """The canonical form of a text, and for each of its characters the end of the raw characters it stands for.

    For quotations, which are short; sources only need `canonical`.
    """

    def __init__(self, text: str) -> None:
        self.raw = ESCAPE.sub(lambda m: chr(int(m[1], 16)), text)
        self.ends: list[int] = []
        folded: list[str] = []
        ends: list[int] = []
        for start, stop in clusters(self.raw):
            for c in unicodedata.normalize("NFKC", self.raw[start:stop]).translate(FOLD):
                folded.append(c)
                ends.append(stop)
        joined = "".join(folded)
        gone = {k for m in IMAGE_NAME.finditer(joined) for k in range(*m.span())}
        out: list[str] = []
        space = False
        for k, c in enumerate(joined):
            if k in gone or c.isspace():
                space = bool(out)
                continue
            if space:
                out.append(" ")
                self.ends.append(ends[k - 1])
                space = False
            out.append(c)
            self.ends += [ends[k]] * len(c.lower())
        self.text = "".join(out).lower()  # as a whole: a final sigma has its own small letter

    def raw_prefix(self, n: int) -> str:
        """The raw text that the first n canonical characters stand for."""
        return self.raw[: self.ends[n - 1]].rstrip() if n else ""


def clusters(text: str) -> Iterator[tuple[int, int]]:
    """Spans that normalise by themselves: a character, and what composes with it."""
    start = 0
    for k in range(1, len(text) + 1):
        if k == len(text) or text[k] < "\x80" or stands_alone(text[start:k], text[k]):
            yield start, k
            start = k


def stands_alone(before: str, c: str) -> bool:
    """Whether a character neither composes with the text before it nor changes its order."""
    form = unicodedata.normalize("NFKC", before[-MOST_MARKS:] + c)
    return not unicodedata.combining(unicodedata.normalize("NFKD", c)[0]) and form == unicodedata.normalize("NFKC", before[-MOST_MARKS:]) + unicodedata.normalize("NFKC", c)


def agreement(needle: str, hay: str) -> int:
    """The length of the longest beginning of the needle that occurs in the hay: where one occurs, all shorter ones do."""
    return bisect_left(range(1, len(needle) + 1), True, key=lambda n: needle[:n] not in hay)


def judge_quote(quote: str, hay: str) -> tuple[bool, str, str]:
    """(holds, why, verified span) of a quotation against canonical source text."""
    own = Canonical(quote)
    n = len(own.text)
    return verdict(own, n if own.text in hay else agreement(own.text, hay) if n >= SHORTEST else 0)


def verdict(own: Canonical, same: int) -> tuple[bool, str, str]:
    """(holds, why, verified span) of a quotation whose first `same` canonical characters are in the source.

    Too short to prove anything; verbatim; verbatim but for up to TAIL stray characters at its end, which the span leaves
    out; diverging from a passage of the source after a fair beginning; or not found.
    """
    n = len(own.text)
    if n < SHORTEST:
        return False, "too short", ""
    if same == n:
        return True, "verbatim", own.raw
    if same >= SHORTEST and n - same <= TAIL:
        return True, "stray tail", own.raw_prefix(same)
    return False, "diverges" if same >= NEAR * n else "not found", ""


QUOTE_TYPE = T.StructType([T.StructField("holds", T.BooleanType()), T.StructField("why", T.StringType()), T.StructField("span", T.StringType())])


@F.pandas_udf(QUOTE_TYPE)
def verify_quote(quote: pd.Series, source: pd.Series) -> pd.DataFrame:
    """holds, why and span of each quotation against its source; null if either is null. A batch folds each source once."""
    hays = {s: canonical(s) for s in set(source.dropna())}
    rows = [(None, None, None) if q is None or s is None else judge_quote(q, hays[s]) for q, s in zip(quote, source, strict=True)]
    return pd.DataFrame(rows, columns=["holds", "why", "span"])
