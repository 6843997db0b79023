"""Which filings have to be read: signals in their documents by configured patterns, the evidence for each, and a decision that never drops on doubt.

Defined cases: a null text has no signals; a filing without documents is read, as is one without a signal; repeated documents count once for a decision.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import ledger

#: Characters of a match that are shown, and matches that are. Fixed values.
SHOWN, EVIDENCE = 80, 3


def signals(text: Column, patterns: dict[str, list[str]], headline: int) -> Column:
    """array of struct(signal, strength, first_at, n_patterns, evidence) of the signals whose patterns (in either case) match.

    Strong if a first match begins before `headline`, else a mention. Evidence: the first matches by place, as struct(at, matched, pattern).
    """
    def hit(pattern: str) -> Column:
        p = f"(?i){pattern}"
        return F.struct((F.regexp_instr(text, F.lit(p)) - 1).alias("at"), F.substring(F.regexp_extract(text, p, 0), 1, SHOWN).alias("matched"), F.lit(pattern).alias("pattern"))

    def found(name: str) -> Column:
        hits = F.array_sort(F.filter(F.array(*map(hit, patterns[name])), lambda h: h["at"] >= 0))
        first = lambda hs: F.get(hs, F.lit(0))["at"]
        return ledger.let(hits, lambda hs: F.when(F.size(hs) > 0, F.struct(F.lit(name).alias("signal"), F.when(first(hs) < headline, "strong").otherwise("mention").alias("strength"), first(hs).alias("first_at"), F.size(hs).alias("n_patterns"), F.slice(hs, 1, EVIDENCE).alias("evidence"))))

    return F.array_compact(F.array(*map(found, patterns)))


def decision(strong: Column, seen: Column, material: list[str], narrative: list[str], routine: list[str]) -> Column:
    """struct(decision, reason, routes) of a filing by the names of its strong signals and of all.

    Read for a strong material signal or any narrative one; a routine filing is kept by its date only if no material signal is in
    it, not even in passing; all else is read.
    """
    among = lambda names, kinds: F.array_sort(F.array_intersect(names, F.array(*map(F.lit, kinds)).cast("array<string>")))
    hard, told, usual, weak = among(strong, material), among(seen, narrative), among(strong, routine), among(seen, material)
    some = lambda c: F.size(c) > 0
    names = lambda c: F.concat(F.lit(" ("), F.array_join(c, ", "), F.lit(")"))
    routes = F.array_compact(F.array(F.when(some(hard), "events"), F.when(some(told), "investor_qa")))
    events = F.array(F.lit("events"))
    to = lambda what, why, where: F.struct(F.lit(what).alias("decision"), why.alias("reason"), where.alias("routes"))
    return (
        F.when(some(hard) & some(told), to("read", F.concat(F.lit("material and narrative"), names(hard), names(told)), routes))
        .when(some(hard), to("read", F.concat(F.lit("strong material signal"), names(hard)), routes))
        .when(some(told), to("read", F.concat(F.lit("narrative content"), names(told)), routes))
        .when(some(usual) & ~some(weak), to("date_only", F.concat(F.lit("routine, nothing material in it"), names(usual)), F.array().cast("array<string>")))
        .when(some(usual), to("read", F.concat(F.lit("routine, but material in passing"), names(usual), names(weak)), events))
        .when(some(weak), to("read", F.concat(F.lit("material in passing"), names(weak)), events))
        .otherwise(to("read", F.lit("no signal matched"), events))
    )


def triage(filings: DataFrame, docs: DataFrame, patterns: dict[str, list[str]], headline: int, kinds: dict[str, list[str]]) -> DataFrame:
    """accession, fiscal_year, n_docs, decision, reason, routes of the filings (accession, fiscal_year) by their documents (accession, text).

    `kinds`: the names of the material, narrative and routine signals. Signals are looked for in the whole texts as they are.
    """
    found = docs.select("accession", signals(F.col("text"), patterns, headline).alias("s"))
    names = lambda keep: F.array_distinct(F.flatten(F.collect_list(F.transform(F.filter("s", keep), lambda s: s["signal"]))))
    by_filing = found.groupBy("accession").agg(F.count("*").alias("n_docs"), names(lambda s: s["strength"] == "strong").alias("strong"), names(lambda s: F.lit(True)).alias("seen"))
    judged = filings.select("accession", "fiscal_year").join(by_filing, "accession", "left")
    none = F.struct(F.lit("read").alias("decision"), F.lit("no text to judge by").alias("reason"), F.array(F.lit("events")).alias("routes"))
    verdict = F.when(F.col("n_docs").isNull(), none).otherwise(decision(F.col("strong"), F.col("seen"), kinds["material"], kinds["narrative"], kinds["routine"]))
    return judged.withColumn("v", verdict).select("accession", "fiscal_year", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "v.*")


def triage_counts(triaged: DataFrame) -> DataFrame:
    """fiscal_year, decision, n."""
    return triaged.groupBy("fiscal_year", "decision").agg(F.count("*").alias("n"))


def signal_counts(docs: DataFrame, patterns: dict[str, list[str]], headline: int) -> DataFrame:
    """signal, strength, n: in how many documents (text) each signal is, by strength."""
    each = docs.select(F.explode(signals(F.col("text"), patterns, headline)).alias("s"))
    return each.groupBy("s.signal", "s.strength").agg(F.count("*").alias("n"))


def catalogued(rows: DataFrame, year_end: tuple[int, int], window: tuple[int, int], gap: list[str], scope: dict[str, dict[str, list[str]]], amendments: list[str]) -> DataFrame:
    """A company's filings (form, filing_date, report_date, items as one text) with their fiscal year and its basis, disposition and reason, and whether they are in the window."""
    items = F.filter(F.transform(F.split(F.coalesce("items", F.lit("")), ","), lambda i: F.trim(i)), lambda i: i != "")
    out = rows.withColumn("items", items).withColumn("f", ledger.fiscal_year_of(F.col("form"), F.col("report_date"), F.col("filing_date"), *year_end)).withColumn("d", ledger.disposition(F.col("form"), F.col("items"), gap, scope, amendments))
    return out.select("*", F.col("f.fiscal_year").alias("fiscal_year"), F.col("f.basis").alias("fy_basis"), "d.disposition", "d.reason").drop("f", "d").withColumn("in_window", F.coalesce(F.col("fiscal_year").between(*window), F.lit(False)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of several tasks that feed one field, all kept."""
    return reduce(DataFrame.unionByName, frames)


def first_of_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`, by a grouped minimum: a hot key is combined before it is shuffled."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("first"))
    return picked.select(*(F.col(c) if c in keys else F.col(f"first.{c}").alias(c) for c in df.columns))
