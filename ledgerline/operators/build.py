"""The facts of a ledger from what was extracted: sources found, judged, corrected, re-anchored, named, and gated before they are handed on.

The order matters: a correction changes the value that an id is made of, and a vote's quotation is re-anchored before it is. Gates are taken in the pass that
writes: every correction has met one fact, no quotation holds a character spelled as an escape, no two facts have one id. Of very many facts some have the same 8 digits by chance: such
facts get 16 (`named_apart`), so only facts that say the same share an id. A broken gate raises, and
nothing is returned.

`raw`: fact (unique), field, fiscal_year, value (a JSON object), quote. `listing`: fact, place, source_id. `sources`: source_id, form, accession,
section_key, filing_date, text. `corrections`: id, seq, field, fiscal_year, accession, match and set (JSON objects).

Defined cases: a fact without a source has null source columns, low confidence and its quotation as it stands; a null value is an empty object; empty tables give empty ones.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.quotes import judge_quote
from ledgerline.functions.text import canonical
from ledgerline.functions.values import DIGITS, LONGER, WHOLE, canonical_text, value_id
from ledgerline.operators import ledger
from ledgerline.operators.attribution import attribute
from ledgerline.sources.stages import Stages

#: The numbers of a vote, in the order of its table. Fixed values.
VOTE_NUMBERS = ("votes_for", "votes_against", "withheld", "abstentions", "broker_non_votes")
VOTES = "vote_results"
#: Corrections that a build may have: they are broadcast.
MOST_FIXES = 10_000
REANCHORED = "re-anchored onto the row with the figures"


def figures_of(value: dict) -> list[str]:
    return [f"{value[k]:,}" for k in VOTE_NUMBERS if isinstance(value.get(k), int)]


def evidencing_span(value: dict, text: str) -> str | None:
    """The stretch of a text that has a vote's figures in its table's order: after the name of who was voted on, else the first; None with under two figures."""
    numbers = figures_of(value)
    if len(numbers) < 2 or not text:
        return None
    row = r"\s*".join(map(re.escape, numbers))
    name = re.search(r"(?:director|nominee)\s+(.+?)\s*$", str(value.get("matter") or ""), re.I)
    own = re.search(re.escape(name[1].strip()) + r"\s*" + row, text) if name else None
    found = own or re.search(row, text)
    return found[0] if found else None


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("span", "why")]))
def reanchored(value: pd.Series, span: pd.Series, why: pd.Series, text: pd.Series) -> pd.DataFrame:
    """The span of a vote: as it is if it has all figures, else the row of the section that has them, if that verifies."""
    out = []
    for v, s, w, t in zip(value, span, why, text, strict=True):
        fields = json.loads(v)
        need = figures_of(fields)
        if t and need and not all(n in s for n in need) and (found := evidencing_span(fields, t)):
            holds, _, verified = judge_quote(found, canonical(t))
            if holds and all(n in verified for n in need):
                s, w = verified, f"{w} — {REANCHORED}"
        out.append((s, w))
    return pd.DataFrame(out, columns=["span", "why"])


@F.pandas_udf(T.StructType([T.StructField(c, T.StringType()) for c in ("value", "correction", "was")]))
def patched(value: pd.Series, fixes: pd.Series) -> pd.DataFrame:
    """A value in canonical form after the first of its corrections that fits; its id, and what the changed keys were."""
    out = []
    for v, listed in zip(value, fixes, strict=True):
        fields = json.loads(v) if v else {}
        hit = next((f for f in (listed if listed is not None else []) if all(fields.get(k) == x for k, x in json.loads(f["match"]).items())), None)
        change = json.loads(hit["set"]) if hit else {}
        out.append((canonical_text({**fields, **change}), hit["id"] if hit else None, canonical_text({k: fields.get(k) for k in change}) if hit else None))
    return pd.DataFrame(out, columns=["value", "correction", "was"])


def field_code(field: Column) -> Column:
    """The code of a field's ids: its own, else its first four letters."""
    return F.coalesce(*(F.when(field == name, code) for name, code in ledger.FIELD_CODES.items()), F.upper(F.substring(field, 1, 4)))


def named_apart(facts: DataFrame, hashed: str) -> DataFrame:
    """`facts` with id, a text that ends with a hash's WHOLE digits cut to DIGITS, or to LONGER where different texts agree that far, in place of `hashed`."""
    cut = lambda digits: F.left(hashed, F.length(hashed) - (WHOLE - digits))
    facts = facts.withColumn("_short", cut(DIGITS))
    shared = facts.groupBy("_short").agg((F.min(hashed) < F.max(hashed)).alias("_shared")).where("_shared")
    return facts.join(shared, "_short", "left").withColumn("id", F.when(F.col("_shared"), cut(LONGER)).otherwise(F.col("_short"))).drop(hashed, "_short", "_shared")


def build(raw: DataFrame, listing: DataFrame, sources: DataFrame, corrections: DataFrame, low_sections: list[str]) -> DataFrame:
    """fact, id, field, fiscal_year, value, quote, verified, why, confidence, reasons, source_id, form, accession, section_key, filing_date, correction, was."""
    stages = Stages(raw.sparkSession)
    if (n := corrections.limit(MOST_FIXES + 1).count()) > MOST_FIXES:
        raise ValueError(f"more than {MOST_FIXES} corrections")
    if n != corrections.select("id").distinct().count():
        raise ValueError("corrections share an id")
    named = attribute(raw.select(F.col("fact").alias("fact_id"), "quote"), listing.withColumnRenamed("fact", "fact_id"), sources).withColumnRenamed("fact_id", "fact")
    about = sources.select("source_id", "form", "accession", "section_key", "filing_date").dropDuplicates(["source_id"])
    facts = raw.select("fact", "field", "fiscal_year", F.coalesce("value", F.lit("{}")).alias("value")).join(named, "fact").join(about, "source_id", "left")
    fixes = corrections.groupBy("field", "fiscal_year", "accession").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "id", "match", "set"))), lambda c: F.struct(c["id"].alias("id"), c["match"].alias("match"), c["set"].alias("set"))).alias("fixes"))
    judged = facts.join(F.broadcast(fixes), ["field", "fiscal_year", "accession"], "left").withColumn("p", patched("value", "fixes")).drop("value", "fixes").select("*", "p.*").drop("p")
    judged = stages.keep(judged.withColumn("c", ledger.confidence(F.col("section_key"), low_sections, F.col("verified"))).select("*", "c.*").drop("c"))
    is_vote = (F.col("field") == VOTES) & F.col("verified")
    texts = sources.select("source_id", "text").dropDuplicates(["source_id"])
    votes = judged.where(is_vote).join(texts, "source_id", "left").withColumn("r", reanchored("value", "span", "why", "text")).select(*(F.col(f"r.{c}").alias(c) if c in ("span", "why") else F.col(c) for c in judged.columns))
    every = votes.unionByName(judged.where(~F.coalesce(is_vote, F.lit(False))))
    hashed = value_id(field_code(F.col("field")), F.col("field"), F.col("fiscal_year"), F.col("value"), F.col("form"), F.col("accession"), F.col("section_key"), F.col("span"), WHOLE)
    named = named_apart(stages.keep(every.withColumn("hashed", hashed)), "hashed")
    seen = Observation()
    columns = ["fact", "id", "field", "fiscal_year", "value", F.col("span").alias("quote"), "verified", "why", "confidence", "reasons", "source_id", "form", "accession", "section_key", "filing_date", "correction", "was"]
    out = stages.keep(named.select(*columns).observe(seen, F.count("*").alias("facts"), F.count_if(F.col("quote").rlike(r"\\u[0-9a-fA-F]{4}")).alias("escapes"), F.count("correction").alias("corrected")))
    gates(out, corrections, seen.get)
    return out


def gates(out: DataFrame, corrections: DataFrame, seen: dict[str, int]) -> None:
    """Raise if an id is shared, a correction has not met exactly one fact, or a quotation has a spelled-out character."""
    wrong = [f"{seen['escapes']} quotations with spelled-out characters"] if seen["escapes"] else []
    shared = out.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").limit(20).collect()  # an error message shows some
    wrong += [f"id {r['id']} of {r['n']} facts" for r in shared]
    met = out.where("correction is not null").groupBy(F.col("correction").alias("id")).agg(F.count("*").alias("n"))
    years = out.select("fiscal_year").distinct()
    missed = corrections.join(years, "fiscal_year", "left_semi").select(F.col("id").cast("string").alias("id")).join(met, "id", "left").where("coalesce(n, 0) <> 1").limit(20).collect()
    wrong += [f"correction {r['id']} met {r['n'] or 0} facts" for r in missed]
    if wrong:
        raise ValueError("nothing is handed on: " + "; ".join(wrong))
