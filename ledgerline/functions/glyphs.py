"""Texts of PDF pages whose font maps glyph ids to nothing: `(cid:N)` for each character.

The code book of each document is found from the document: blanks are by far the most frequent characters of prose, so the most frequent id is the blank and its
distance from 32 holds for all. Ids outside it are taken from the ligatures, or left visible; a result that is no readable English is an error, not a text.

Defined cases: a text without ids stays as it is (and is judged too); of equally frequent ids the smallest counts; a null text gives nulls.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.shipping import ship

GLYPH = re.compile(r"\(cid:(\d+)\)")
#: Digits of an id that is read without the pattern.
DIGITS = 6
#: Ids with a character of their own, words that English prose has, and what a readable text is. Fixed values.
LIGATURES = {299: "fi", 300: "fl", 301: "ff", 338: "’", 348: "-"}
COMMON = ("the", "and", "our", "year", "that", "for", "with", "we")
LEAST_WORDS, LEAST_PRINTABLE, MOST_UNKNOWN = 5, 0.95, 0.001


def readable(text: str) -> bool:
    low = text.lower()
    marks = text.replace("\n", "").replace("\t", "")
    printable = len(text) if marks.isprintable() else sum(n for c, n in Counter(text).items() if c.isprintable() or c in "\n\t")
    return bool(text) and sum(f" {w} " in low for w in COMMON) >= LEAST_WORDS and printable > LEAST_PRINTABLE * len(text) and text.count("�") < MOST_UNKNOWN * len(text)


class Same(dict):
    """What is no key stays as it is."""

    def __missing__(self, c: str) -> str:
        return c


@F.pandas_udf(T.StringType())
def in_glyphs(text: pd.Series, font: pd.Series) -> pd.Series:
    """Printable ASCII texts as a page gives them whose font has its glyphs `font` after the characters; line feeds stay."""
    tables = {f: Same({chr(c): f"(cid:{c + int(f)})" for c in range(0x20, 0x7F)}) for f in font.dropna().unique()}
    return pd.Series([None if t is None or pd.isna(f) else "".join(map(tables[f].__getitem__, t)) for t, f in zip(text, font, strict=True)], dtype=object)


def occurrences(raw: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Start, stop and id of each match of GLYPH; none for a text with ids of other than ordinary digits, which is left to the pattern."""
    if not raw.isascii():
        return None
    data = np.frombuffer(raw.encode() + bytes(DIGITS + 6), np.uint8)
    at = np.flatnonzero(data == ord("("))
    for k, c in enumerate(b"cid:", 1):
        at = at[data[at + k] == c]
    ids, digits, more = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for k in range(DIGITS + 1):
        if not more.any():
            break
        d = data[at + 5 + k] - np.uint8(ord("0"))  # others wrap to 10 or more
        more &= d < 10
        ids = np.where(more, ids * 10 + d, ids)
        digits += more
    stop = at + 5 + digits
    if more.any() or ((data[at + 5] == ord("0")) & (digits > 1)).any():
        return None
    whole = (digits > 0) & (data[stop] == ord(")"))
    return at[whole], stop[whole] + 1, ids[whole]


def joined(raw: str, at: np.ndarray, stop: np.ndarray, letters: list[str]) -> str:
    """The text with a letter at each place, and what stands between the places."""
    if not letters:
        return raw
    out, begin = [raw[: at[0]]], 0
    for k in (np.flatnonzero(at[1:] != stop[:-1]) + 1).tolist():
        out += [*letters[begin:k], raw[stop[k - 1] : at[k]]]
        begin = k
    return "".join([*out, *letters[begin:], raw[stop[-1] :]])


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("shift", T.IntegerType()), T.StructField("n_unknown", T.LongType()), T.StructField("readable", T.BooleanType())]))
def spelled(raw: pd.Series) -> pd.DataFrame:
    out = []
    for text in raw:
        if text is None:
            out.append((None, None, None, None))
            continue
        places = occurrences(text)
        if places is None:
            parts = GLYPH.split(text)  # every second one is an id
            counts = Counter(parts[1::2])
        else:
            at, stop, ids = places
            distinct, which, times = np.unique(ids, return_inverse=True, return_counts=True)
            counts = dict(zip(map(str, distinct.tolist()), times.tolist(), strict=True))
        blank = min(((-n, int(g)) for g, n in counts.items()), default=None)
        shift = None if blank is None else 32 - blank[1]
        letters = {g: LIGATURES.get(int(g)) or (chr(int(g) + shift) if 0x20 <= int(g) + shift <= 0x7E else f"�[cid:{int(g)}]") for g in counts}
        if places is None:
            parts[1::2] = map(letters.__getitem__, parts[1::2])
            said = "".join(parts)
        else:
            said = joined(text, at, stop, np.array(list(letters.values()), object)[which].tolist() if letters else [])
        out.append((said, shift, sum(n for g, n in counts.items() if letters[g].startswith("�")), readable(said)))
    return pd.DataFrame(out, columns=["text", "shift", "n_unknown", "readable"]).astype({"shift": "Int32", "n_unknown": "Int64"})


def decoded(docs: DataFrame) -> DataFrame:
    """doc, text, shift, n_unknown, readable of raw texts (doc, text); shift is null where nothing had to be decoded."""
    ship(docs.sparkSession)
    return docs.select("doc", spelled("text").alias("s")).select("doc", "s.*")
