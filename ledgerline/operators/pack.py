"""What is handed to whoever writes: the facts that have a source, small, with what was left out listed; measures of them; and whether a document is still current.

`facts`: id, field, fiscal_year, value (JSON), quote, verified, why, confidence, reasons, form, accession, section_key, filing_date (null without a source), as
`build` gives them. Defined cases: no facts give empty tables and a rate of null; a null section is no letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import canon_text
from ledgerline.functions.values import leaves
from ledgerline.sources.shipping import ship

#: Characters from which a value's text is asked whether its quotation has it. Fixed value.
LONG_VALUE = 40
LETTER = "letter_full_text"


def source_text(c: str = "") -> Column:
    """form|accession|section|day of a fact's source, empty without one."""
    parts = F.concat_ws("|", *(F.coalesce(F.col(f"{c}{x}"), F.lit("")) for x in ("form", "accession", "section_key", "filing_date")))
    return F.when(F.col(f"{c}accession").isNull(), "").otherwise(parts)


def packed(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded): id, field, fiscal_year, claim, quote, src, confidence, why, quote_unverified of the facts with a source, where what is as
    usual (high, verified) is left out; and id, field, fiscal_year, confidence, why of the others, which are never dropped in silence."""
    low = ~F.col("confidence").eqNullSafe("high")
    kept = facts.where("accession is not null").select("id", "field", "fiscal_year", F.col("value").alias("claim"), "quote", source_text().alias("src"), F.when(low, F.col("confidence")).alias("confidence"), F.when(low, F.coalesce(F.nullif("reasons", F.lit("")), F.col("why"))).alias("why"), F.when(~F.coalesce("verified", F.lit(False)), True).alias("quote_unverified"))
    return kept, facts.where("accession is null").select("id", "field", "fiscal_year", "confidence", "why")


def verbatim_rate(facts: DataFrame, least: int = LONG_VALUE) -> DataFrame:
    """One row: n_verbatim, n_values of the long texts in the values, at any depth, that stand in their own fact's quotation."""
    ship(facts.sparkSession)
    said = leaves(facts.select("id", "value"), "id", "value").where((F.col("kind") == "STRING") & (F.length("leaf") >= least)).select("id", "leaf")
    found = said.join(facts.select("id", "quote"), "id").select(F.contains(canon_text(F.coalesce("quote", F.lit(""))), canon_text("leaf")).alias("held"))
    return found.agg(F.count_if("held").alias("n_verbatim"), F.count("*").alias("n_values"))


def slice_census(index: DataFrame) -> DataFrame:
    """code, year, n: how many ids there are of each field and year."""
    parts = F.split("id", "-")
    return index.groupBy(parts[0].alias("code"), parts[1].alias("year")).agg(F.count("*").alias("n"))


def document_window(facts: DataFrame, filings: DataFrame, first: int, last: int) -> DataFrame:
    """fiscal_year, first_filed, last_filed, n_filings, outside: the days of the filings that each year's facts are drawn from, and those filings (accession,
    fiscal_year) that belong to no year of the window."""
    drawn = facts.where("accession is not null").groupBy("fiscal_year", "accession").agg(F.min("filing_date").alias("low"), F.max("filing_date").alias("high"))
    own = filings.select("accession", F.col("fiscal_year").alias("of")).dropDuplicates(["accession"])
    outside = F.when(~F.coalesce(F.col("of").between(first, last), F.lit(False)), F.col("accession"))
    return drawn.join(own, "accession", "left").groupBy("fiscal_year").agg(F.min("low").alias("first_filed"), F.max("high").alias("last_filed"), F.count("*").alias("n_filings"), F.array_sort(F.collect_set(outside)).alias("outside"))


def segments_basis(texts: DataFrame) -> DataFrame:
    """fiscal_year, reports_segments: whether the year's texts (fiscal_year, text) speak of reportable segments; if not, what they name are no segments."""
    return texts.groupBy("fiscal_year").agg(F.coalesce(F.max(F.contains(F.lower("text"), F.lit("reportable segment"))), F.lit(False)).alias("reports_segments"))


def document_status(docs: DataFrame, settings: DataFrame) -> DataFrame:
    """doc, status, drift of each document: missing, unstamped, stale, drifted or current.

    `docs`: doc, written (whether it is there), stamped, model, effort, prompt, changed (time), basis (the document that it must not be older than). `settings`,
    one row: current (pack hash), model, effort, prompt. What a record doesn't have is no drift.
    """
    now = F.broadcast(settings.select(*(F.col(c).alias(f"now_{c}") for c in ("current", "model", "effort", "prompt"))))  # one row
    older = docs.select(F.col("doc").alias("basis"), F.col("changed").alias("basis_changed"))
    seen = docs.join(older, "basis", "left").join(now)
    differs = lambda c: F.when(F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"now_{c}")), c)
    drift = F.array_compact(F.array(differs("prompt"), differs("model"), differs("effort"), F.when(F.col("basis_changed") > F.col("changed"), "basis")))
    status = F.when(~F.coalesce("written", F.lit(False)), "missing").when(F.col("stamped").isNull(), "unstamped").when(F.col("stamped") != F.col("now_current"), "stale").when(F.size("drift") > 0, "drifted").otherwise("current")
    return seen.withColumn("drift", drift).select("doc", status.alias("status"), "drift")


def gathered(sections: DataFrame, wanted: DataFrame) -> DataFrame:
    """`sections` (fiscal_year, key, accession, ok, text) that a task reads (`wanted`: task, fiscal_year, key, place): task, fiscal_year, place, key, accession, text; only those that were read well."""
    return wanted.select("task", "fiscal_year", "key", "place").join(sections.where("ok and text is not null").select("fiscal_year", "key", "accession", "text"), ["fiscal_year", "key"]).select("task", "fiscal_year", "place", "key", "accession", "text")
