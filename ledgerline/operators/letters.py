"""A letter inside a longer document: from its salutation to its sign-off, or to a signature that makes a letter of a fair length.

All marks of a text are found in one scan for each pattern, then chosen by their offsets. Defined cases: a null text, or one without a salutation or an end, gives
an error and no letter; of equal starts the first pattern's counts.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LETTER = "letter string, start int, stop int, rule string, n_salutations int, n_signoffs int, error string"


def bounds(text: str, starts: list[str], ends: list[str], signatures: list[str], tail: int, least: int, most: int) -> tuple:
    """The fields of LETTER. `starts` and `ends` match in either case, `signatures` as they are.

    The end is the first sign-off after the first salutation and `tail` characters for the name; without one, the first signature that gives a
    letter of `least` to `most` characters, and then a page break within the tail ends it.
    """
    find = lambda patterns, flags: sorted((m.span() for p in patterns for m in re.finditer(p, text, flags)), key=lambda s: s[0])
    salutations = find(starts, re.I)
    if not salutations:
        return None, None, None, None, 0, 0, "no salutation"
    start = salutations[0][0]
    signoffs = [s for s in find(ends, re.I) if s[0] > start]
    stop_at = lambda end: min(end + tail, len(text))
    if signoffs:
        stop, rule = stop_at(signoffs[0][1]), "sign-off"
    else:
        fits = [s for s in find(signatures, 0) if s[0] > start and least <= stop_at(s[1]) - start <= most]
        if not fits:
            return None, start, None, None, len(salutations), 0, "no sign-off and no signature that fits"
        end, rule = fits[0][1], "signature"
        page = text.find("\f", end, stop_at(end))
        stop = page if page >= 0 else stop_at(end)
    return text[start:stop].strip(), start, stop, rule, len(salutations), len(signoffs), None


def letter_of(text: Column, starts: list[str], ends: list[str], signatures: list[str], tail: int = 100, least: int = 1_000, most: int = 80_000) -> Column:
    """struct of LETTER for each text."""
    @F.pandas_udf(LETTER)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [(None, None, None, None, 0, 0, "no text") if t is None else bounds(t, starts, ends, signatures, tail, least, most) for t in texts]
        frame = pd.DataFrame(rows, columns=[f.split()[0] for f in LETTER.split(", ")])
        return frame.astype({c: "Int32" for c in ("start", "stop", "n_salutations", "n_signoffs")})

    return run(text)
