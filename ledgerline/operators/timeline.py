"""A timeline of events that several sources report: which reports are one event, what is left as possible, and the order.

Reports (`rows`): id, position (order of reports, unique), field, type, stated (date as stated), description, quote, accession, source, confidence,
fiscal_year; leadership reports also have name, change, role, which identify a change whatever its wording.
Reports of one date from different filings are one event if they are alike; of the undated, near-equal ones are only listed.

Defined cases: a report without an accession shares its source with none; a null description is like none; an empty table gives empty ones; a null
confidence is not high. A cluster's reports meet in one row, as they are that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import graph, ledger, similar
from ledgerline.sources.stages import Stages

#: Ratios from which reports of a date are one event, or possibly one, and from which undated ones are listed. Fixed values.
MERGE, POSSIBLE, UNDATED = 55, 45, 95
#: Types that give way to any other. Fixed values.
VAGUE = ["other", ""]
#: An amendment that reports again what was reported. Fixed pattern.
BACK_REFERENCE = r"(?i)as (?:previously|originally) (?:reported|announced|disclosed|filed)|the original (?:form|report|filing|current report)|(?:amends?|amended|amending|supplements?) (?:and restates? )?the (?:current report|original|report on form)"


def leadership_sentence(name: Column, change: Column, role: Column, reason: Column) -> Column:
    """name change — role (stated reason: reason), without what is missing; a change's underscores are spaces."""
    given = lambda c: F.nullif(c, F.lit(""))
    bits = F.array_compact(F.array(given(name), given(F.translate(change, "_", " ")), given(role)))
    text = F.when(F.size(bits) > 2, F.concat(F.concat_ws(" ", F.slice(bits, 1, 2)), F.lit(" — "), F.element_at(bits, -1))).otherwise(F.concat_ws(" ", bits))
    return F.concat(text, F.coalesce(F.concat(F.lit(" (stated reason: "), given(reason), F.lit(")")), F.lit("")))


def identity(*parts: Column) -> Column:
    """What identifies a change of leadership: its parts trimmed and in lower case."""
    return F.concat_ws(" | ", *(F.lower(F.trim(F.coalesce(p, F.lit("")))) for p in parts))


def dated(rows: DataFrame) -> DataFrame:
    """`rows` with date and precision; a date that can't be sorted is none."""
    return rows.withColumn("_d", ledger.partial_date(F.col("stated"))).withColumns({"date": F.col("_d.date"), "precision": F.when(F.col("_d.date").isNotNull(), F.col("_d.precision"))}).drop("_d")


def _compared(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("position").alias("id"), F.col("date").alias("block"), F.col("description").alias("text"), F.array("accession").alias("sources"))


def same_date_pairs(rows: DataFrame) -> DataFrame:
    """date, a, b, score, merges, member: pairs of dated reports of one date and different filings that are one event, or possibly one.

    Reports of one text and filing have the same partners, so the first of them stands for all; if it is one event with another, the rest follow it (member).
    """
    compared = _compared(dated(rows))
    found = Stages(rows.sparkSession).keep(similar.in_blocks(compared, POSSIBLE).withColumn("merges", F.col("score") >= MERGE))
    ends = found.where("merges").select("block", F.explode(F.array("a", "b")).alias("rep")).distinct()
    follow = similar.representatives(compared).where("id <> rep").join(ends, ["block", "rep"]).select("block", F.col("rep").alias("a"), F.col("id").alias("b"), F.lit(100.0).alias("score"), F.lit(True).alias("merges"), F.lit(True).alias("member"))
    both = found.select("block", "a", "b", "score", "merges", F.lit(False).alias("member")).union(follow)
    return both.withColumnRenamed("block", "date")


def undated_pairs(rows: DataFrame) -> DataFrame:
    """a, b, score: near-equal undated reports of different filings, never merged; the first of one text and filing stands for all."""
    return similar.across(_compared(dated(rows).where(F.col("date").isNull())), UNDATED)


def merged(rows: DataFrame, pairs: DataFrame, routine: list[str], material: list[str]) -> DataFrame:
    """One row for each event: ids, fiscal_years, field, type, types_disagree, date, precision, stated, description, also_described_as, quotes, accessions, sources, confidence, corroborating, routine, predates_window.

    The longest description leads; a specific type beats a vague one, the most frequent beats the others, the first of equal ones; the confidence is
    the lowest. An event is routine if a pattern of `routine` is in its description and none of `material`.
    """
    united = graph.components_in_blocks(pairs.where("merges").select(F.col("date").alias("block"), "a", "b"))
    all_rows = dated(rows)
    own = all_rows.join(united.select(F.col("node").alias("position"), "root"), "position", "left").withColumn("root", F.coalesce("root", "position"))
    first_year = all_rows.agg(F.min("fiscal_year").alias("first_year"))  # one row
    parts = ["position", "id", "fiscal_year", "field", "type", "date", "precision", "stated", F.coalesce("description", F.lit("")).alias("description"), "quote", "accession", "source", "confidence"]
    grouped = own.groupBy("root").agg(F.array_sort(F.collect_list(F.struct(*parts))).alias("m"))
    each = lambda name: F.transform("m", lambda x: x[name])
    kinds = lambda name: F.array_sort(F.array_distinct(F.array_compact(each(name))))
    by_length = F.transform(F.array_sort(F.transform("m", lambda x, i: F.struct((-F.length(x["description"])).alias("n"), i.alias("i"), x["description"].alias("d")))), lambda s: s["d"])
    alone = F.size("m") == 1
    specific = F.filter(each("type"), lambda t: t.isNotNull() & ~t.isin(VAGUE))
    counted = F.transform(F.array_distinct(specific), lambda t, i: F.struct((-F.size(F.filter(specific, lambda u: u == t))).alias("n"), i.alias("i"), t.alias("t")))
    the_type = F.when(alone, F.col("m")[0]["type"]).when(F.size(specific) > 0, F.array_min(counted)["t"]).otherwise("other")
    text = F.col("description")
    any_of = lambda patterns: F.coalesce(*(F.when(text.rlike(p), True) for p in patterns), F.lit(False))
    lead = F.col("m")[0]
    out = grouped.select(
        kinds("id").alias("ids"), kinds("fiscal_year").alias("fiscal_years"),
        F.when(alone, lead["field"]).when(F.exists("m", lambda x: x["field"] == "events"), "events").otherwise("leadership").alias("field"),
        the_type.alias("type"), F.when(~alone & (F.size(F.array_distinct(specific)) > 1), F.array_sort(F.array_distinct(specific))).alias("types_disagree"),
        lead["date"].alias("date"), lead["precision"].alias("precision"), lead["stated"].alias("stated"),
        by_length[0].alias("description"), F.when(~alone, F.slice(by_length, F.lit(2), F.size("m"))).alias("also_described_as"),
        F.array_compact(each("quote")).alias("quotes"), kinds("accession").alias("accessions"), kinds("source").alias("sources"),
        F.when(alone, lead["confidence"]).when(F.exists("m", lambda x: ~x["confidence"].eqNullSafe("high")), "low").otherwise("high").alias("confidence"),
    ).withColumn("corroborating", F.size("accessions").cast("bigint")).withColumn("routine", any_of(routine) & ~any_of(material))
    return out.join(F.broadcast(first_year)).withColumn("predates_window", F.coalesce(F.substring("date", 1, 4) < F.col("first_year").cast("string"), F.lit(False))).drop("first_year")


def counts(rows: DataFrame, events: DataFrame, conflicts: DataFrame) -> DataFrame:
    """One row: input_records, rows_after_merge, records_absorbed, dated, period_unclear, routine, corroborated, predates_window, date_conflicts."""
    tally = events.agg(F.count("*").alias("rows_after_merge"), F.count("date").alias("dated"), F.count_if(F.col("date").isNull()).alias("period_unclear"), F.count_if("routine").alias("routine"), F.count_if(F.col("corroborating") > 1).alias("corroborated"), F.count_if("predates_window").alias("predates_window"))
    joined = rows.agg(F.count("*").alias("input_records")).join(tally).join(conflicts.agg(F.count("*").alias("date_conflicts")))  # rows of totals
    return joined.select("input_records", "rows_after_merge", (F.col("input_records") - F.col("rows_after_merge")).alias("records_absorbed"), "dated", "period_unclear", "routine", "corroborated", "predates_window", "date_conflicts")


def date_conflicts(rows: DataFrame) -> DataFrame:
    """identity, dates, resolved, resolved_date, resolved_by, ids, filings of changes of leadership with more than one date.

    They are resolved if exactly one report comes from an amendment, that one has a date, and its quotation refers back to the original.
    `rows` also has form and identity.
    """
    known = dated(rows).where("identity is not null and identity <> '' and date is not null")
    amended = F.col("form").endswith("/A")
    grouped = known.groupBy("identity").agg(F.array_sort(F.collect_set("date")).alias("dates"), F.count_if(amended).alias("n"), F.max(F.when(amended, F.struct("date", "accession", F.coalesce(F.col("quote").rlike(BACK_REFERENCE), F.lit(False)).alias("back")))).alias("a"), F.array_sort(F.collect_list("id")).alias("ids"), F.array_sort(F.collect_set("accession")).alias("filings"))
    resolved = (F.col("n") == 1) & F.coalesce("a.back", F.lit(False))
    shown = grouped.where(F.size("dates") > 1).withColumn("resolved", resolved)
    return shown.select("identity", "dates", "resolved", F.when(F.col("resolved"), F.col("a.date")).alias("resolved_date"), F.when(F.col("resolved"), F.array_compact(F.array("a.accession"))).otherwise(F.array().cast("array<string>")).alias("resolved_by"), "ids", "filings")
