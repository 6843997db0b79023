"""Ledger derivations: fiscal assignment with its basis, form rules, confidence, ids over canonical JSON, fingerprints, costs.

Expressions of built-in functions only, so they stay in generated code and are evaluated where the rows lie. Nulls give nulls
unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import fiscal

#: Forms by the rule of their fiscal year, and the bases of an assignment. Fixed values.
PERIODIC, PROXY, LETTER = ["10-K", "10-Q"], ["DEF 14A", "DEFA14A"], ["ARS"]
VERIFIED, OFF_CYCLE, NO_PERIOD = "reportDate (verified period end)", "reportDate.year (period end is OFF-CYCLE — check)", "filingDate (no reportDate)"
COMPLETED, HOLDING = "most recently completed FY at filing", "fiscal year containing filingDate"
#: Field names and the codes of their ids. Fixed values.
FIELD_CODES = {"strategic_priorities": "SP", "segments": "SEG", "headcount": "HC", "leadership": "LEAD", "board": "BRD", "incentive_metrics": "INC", "vote_results": "VOTE", "events": "EVT", "notable_language": "LANG", "investor_qa": "QA"}
#: Characters a token stands for on average. Fixed value.
CHARS_A_TOKEN = 2.66
#: What the C1 range means in Windows-1252, from 0x80; a space where it has no character.
C1 = bytes(range(0x80, 0xA0)).decode("cp1252", "replace").replace("\ufffd", " ")


def base_form(form: Column) -> Column:
    """A form without the mark of an amendment."""
    return F.trim(F.regexp_replace(form, "/A$", ""))


def year_end_of(raw: Column) -> Column:
    """struct(month, day) of four digits MMDD; anything else is 31 December."""
    ok = F.coalesce(raw.rlike(r"^\d{4}$"), F.lit(False))
    part = lambda at, other: F.when(ok, F.substring(raw, at, 2).cast("int")).otherwise(F.lit(other))
    return F.struct(part(1, 12).alias("month"), part(3, 31).alias("day"))


def fiscal_year_of(form: Column, report: Column, filed: Column, month: int, day: int) -> Column:
    """struct(fiscal_year, basis): the year a filing belongs to, and by which rule.

    Periodic reports take the year of a period of report that ends a fiscal year; one that does not gives its calendar year, marked
    off-cycle; without one the year that holds the day of filing counts. Proxy forms never consult the period, which is a meeting's day:
    they and annual letters without a verified period take the year that had ended by the day of filing. All others go by the
    year that holds it.
    """
    base = base_form(form)
    verified, ended, holding = fiscal.from_period(report, month, day), fiscal.completed(filed, month, day), fiscal.containing(filed, month, day)
    rules = [
        (base.isin(PERIODIC) & verified.isNotNull(), verified, VERIFIED),
        (base.isin(PERIODIC) & report.isNotNull(), F.year(report), OFF_CYCLE),
        (base.isin(PERIODIC), holding, NO_PERIOD),
        (base.isin(LETTER) & verified.isNotNull(), verified, VERIFIED),
        (base.isin(PROXY + LETTER), ended, COMPLETED),
        (F.lit(True), holding, HOLDING),
    ]
    return F.coalesce(*(F.when(cond, F.struct(year.cast("bigint").alias("fiscal_year"), F.lit(basis).alias("basis"))) for cond, year, basis in rules))


def disposition(form: Column, items: Column, gap: list[str], scope: dict[str, dict[str, list[str]]], amendments: list[str]) -> Column:
    """struct(disposition, reason) of a filing by the first rule that fits.

    A gap signal, as filed or as its base form; a form out of scope; an amendment where its form has none; a form without an item filter; no items given; an
    item to include; then items of which only the date counts, before items to triage; else out of scope. `scope` has for each form
    the lists `include`, `date_only` and `triage`.
    """
    base = base_form(form)
    why = lambda name, reason: F.struct(F.lit(name).alias("disposition"), reason.alias("reason"))
    both = lambda key: F.array_sort(F.array_intersect(F.coalesce(items, F.array().cast("array<string>")), _listed(base, scope, key)))
    listed = lambda key: F.concat(F.lit(f"{key}: "), F.concat_ws(", ", both(key)))
    filtered = base.isin([f for f, rules in scope.items() if any(rules.values())])
    return (
        F.when(form.isin(gap) | base.isin(gap), why("gap_signal", F.concat(F.lit("gap signal "), form)))
        .when(~base.isin(list(scope)), why("out_of_scope", F.lit("form not in scope")))
        .when(form.endswith("/A") & ~base.isin(amendments), why("out_of_scope", F.lit("amendment")))
        .when(~filtered, why("in_scope", F.lit("every filing of the form")))
        .when(F.coalesce(F.size(items), F.lit(0)) <= 0, why("out_of_scope", F.lit("no items given")))
        .when(F.size(both("include")) > 0, why("in_scope", listed("include")))
        .when(F.size(both("date_only")) > 0, why("date_only", listed("date_only")))
        .when(F.size(both("triage")) > 0, why("triage", listed("triage")))
        .otherwise(why("out_of_scope", F.lit("no listed item")))
    )


def _listed(base: Column, scope: dict[str, dict[str, list[str]]], key: str) -> Column:
    out = F.array().cast("array<string>")
    for form, rules in scope.items():
        out = F.when(base == form, F.array(*map(F.lit, rules.get(key, []))).cast("array<string>")).otherwise(out)
    return out


def confidence(section: Column, low_sections: list[str], verified: Column) -> Column:
    """struct(confidence, reasons): low if the section is a weak one or the quotation isn't verified; the reasons joined."""
    reasons = F.array_compact(F.array(F.when(section.isin(low_sections), "weak section"), F.when(~F.coalesce(verified, F.lit(False)), "quotation not verified")))
    return F.struct(F.when(F.size(reasons) > 0, "low").otherwise("high").alias("confidence"), F.concat_ws("; ", reasons).alias("reasons"))


def json_text(value: Column) -> Column:
    """A string as JSON: marks and control characters escaped, all other characters as they are; null as null."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    named = {"\n": "n", "\r": "r", "\t": "t", "\b": "b", "\f": "f"}
    spelled = reduce(lambda c, k: F.replace(c, F.lit(chr(k)), F.lit("\\" + named.get(chr(k), f"u{k:04x}"))), range(0x20), escaped)
    escaped = F.when(value.rlike(r"[\x00-\x1F]"), spelled).otherwise(escaped)
    return F.coalesce(F.concat(F.lit('"'), escaped, F.lit('"')), F.lit("null"))


def canonical_json(fields: dict[str, Column]) -> Column:
    """An object of JSON values already in text form, by sorted keys with ", " and ": " between."""
    parts = [F.concat(F.lit(f'"{k}": '), fields[k]) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def canonical_map(value: Column) -> Column:
    """A map of strings as a JSON object by sorted keys."""
    entries = F.transform(F.array_sort(F.map_entries(value)), lambda e: F.concat(json_text(e["key"]), F.lit(": "), json_text(e["value"])))
    return F.coalesce(F.concat(F.lit("{"), F.concat_ws(", ", entries), F.lit("}")), F.lit("null"))


def fact_id(code: Column, year: Column, field: Column, value: Column, form: Column, accession: Column, section: Column, quote: Column) -> Column:
    """CODE-FYyear-8 hex digits over what a fact says and where; judgments (confidence) and dates of filing don't count."""
    body = canonical_json({"field": json_text(field), "fiscal_year": F.coalesce(year.cast("string"), F.lit("null")), "value": canonical_map(value), "form": json_text(form), "accession": json_text(accession), "section_key": json_text(section), "quote": json_text(quote)})
    return F.concat(code, F.lit("-FY"), year.cast("string"), F.lit("-"), F.substring(F.sha2(body, 256), 1, 8))


def source_fingerprint(df: DataFrame, key: str, order: str, accession: str, section: str, text: str) -> DataFrame:
    """(key, source_sha256) over accession, section and text of a unit's sources in order, each ended by a zero character.

    A unit's sources are the input of one model call, so they fit in a row.
    """
    one = F.concat(*(x for c in (accession, section, text) for x in (F.coalesce(F.col(c), F.lit("")), F.lit("\0"))))
    each = df.select(key, F.struct(F.col(order).alias("o"), one.alias("t")).alias("s"))
    return each.groupBy(key).agg(F.array_sort(F.collect_list("s")).alias("s")).select(key, F.sha2(F.array_join("s.t", ""), 256).alias("source_sha256"))


def token_estimate(text: Column) -> Column:
    return F.bround(F.length(text) / F.lit(CHARS_A_TOKEN)).cast("bigint")


def usage_cost(usage: DataFrame, prices: DataFrame, cache_write: float, cache_read: float) -> DataFrame:
    """(model, cost) in dollars of tokens at prices a million. `usage`: model, input, output, cache_write, cache_read; `prices`: model, input_price, output_price.

    A model without a price is an error, not a cost of nothing.
    """
    sums = usage.groupBy("model").agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("input", "output", "cache_write", "cache_read")))
    priced = sums.join(F.broadcast(prices.select("model", "input_price", "output_price")), "model", "left")  # a price list: one row a model
    known = F.when(F.col("input_price").isNull(), F.raise_error(F.concat(F.lit("no price for model "), F.col("model"))).cast("double"))
    cost = (F.col("input_price") * (F.col("input") + F.col("cache_write") * cache_write + F.col("cache_read") * cache_read) + F.col("output_price") * F.col("output")) / 1e6
    return priced.select("model", F.coalesce(known, cost).alias("cost"))


def cleaned(text: Column) -> Column:
    """A text whose C1 characters are read as Windows-1252, with one space for each run of white space, trimmed."""
    pairs = [(chr(0x80 + k), c) for k, c in enumerate(C1) if c != " "]
    mapped = F.translate(text, "".join(a for a, _ in pairs), "".join(b for _, b in pairs))
    return F.trim(F.regexp_replace(mapped, r"(?U)\s+", " "))


#: What stands for a passage of caution that was left out. Fixed text.
OMITTED = " [... standard forward-looking-statements caution omitted ...] "


def without_boilerplate(text: Column, is_body: Column, patterns: dict[str, str]) -> Column:
    """A filing's own words, by configured patterns.

    Body: from `starts` on, up to `ends`; the first passage from `caution` to the next `caution_end` is replaced by OMITTED, and what ends it stays;
    without an end nothing is. Exhibit: without what `head` and `image` match. White space is one space.
    """
    starts, ends, caution, caution_end = (F.lit(patterns[k]) for k in ("starts", "ends", "caution", "caution_end"))

    def without_caution(body: Column) -> Column:
        first, opening = F.regexp_instr(body, caution), F.regexp_extract(body, patterns["caution"], 0)
        cut = lambda rest: let(F.regexp_instr(rest, caution_end), lambda end: F.when((first > 0) & (end > 0), F.concat(F.substring(body, F.lit(1), first - 1), F.lit(OMITTED), F.substring(rest, end, F.length(rest)))).otherwise(body))
        return let(F.substring(body, first + F.length(opening), F.length(body)), cut)

    def of_body(squeezed: Column) -> Column:
        begun = let(F.regexp_instr(squeezed, starts), lambda at: F.when(at > 0, F.substring(squeezed, at, F.length(squeezed))).otherwise(squeezed))
        ended = let(begun, lambda t: let(F.regexp_instr(t, ends), lambda at: F.when(at > 0, F.substring(t, F.lit(1), at - 1)).otherwise(t)))
        return let(ended, without_caution)

    of_exhibit = lambda squeezed: F.regexp_replace(F.regexp_replace(squeezed, patterns["head"], ""), patterns["image"], "")
    own = let(F.regexp_replace(text, r"(?U)\s+", " "), lambda squeezed: F.when(is_body, of_body(squeezed)).otherwise(of_exhibit(squeezed)))
    return F.trim(F.regexp_replace(own, r"(?U)\s+", " "))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once: a lambda's variable is never written out twice."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def partial_date(stated: Column) -> Column:
    """struct(date, precision, as_stated): a date of a year, month or day; any other text is kept only as stated."""
    ok = F.coalesce(stated.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), F.lit(False))
    precision = F.when(F.length(stated) == 10, "day").when(F.length(stated) == 7, "month").otherwise("year")
    return F.struct(F.when(ok, stated).alias("date"), F.when(ok, precision).alias("precision"), stated.alias("as_stated"))
