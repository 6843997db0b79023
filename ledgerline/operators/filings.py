"""Rules about single filings, documents, records and names, as expressions of built-in functions. Nulls give false or null, as each says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.operators.ledger import base_form

#: Attachments that are never or rarely read, by the beginning of their type. Fixed values.
ASSETS = ["EX-101", "EX-96", "GRAPHIC", "IMAGE", "JS", "CSS", "HTML", "XML", "JSON", "ZIP", "EXCEL"]
COMPLIANCE = ["EX-21", "EX-23", "EX-24", "EX-31", "EX-32"]
#: Exhibits that tell something, forms whose documents are all read, the item of a vote, the shape of a ticker, what is no name or address of anyone. Fixed values.
NARRATIVE = r"(?i)^EX-(99|13|97|19|10)(?!\d)"
ALWAYS, VOTE_ITEM = ["UPLOAD", "CORRESP"], "5.07"
TICKER = r"^[A-Za-z][A-Za-z0-9.\-]{0,9}$"
PLACEHOLDER = r"(?i)\b(example\.(?:com|org|net)|your[._ ]?name|your[._ ]?email|name@host)\b"
#: Numbers of years that are written as words. Fixed values.
YEARS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"]


def _is(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def in_window(year: Column, first: int, last: int) -> Column:
    """Whether a filing's fiscal year is in scope; one without a year is not."""
    return _is(year.between(first, last))


def kept_attachment(kind: Column, filename: Column) -> Column:
    """struct(kept, reason) of a document inside a filing; what is in doubt is kept."""
    t = F.upper(F.trim(F.coalesce(kind, F.lit(""))))
    begins = lambda names: F.exists(F.array(*map(F.lit, names)), lambda n: F.startswith(t, n))
    reason = F.when(begins(ASSETS), "rendering asset").when(begins(COMPLIANCE), "compliance boilerplate").when(F.coalesce(filename, F.lit("")) == "", "no filename").otherwise("kept")
    return F.struct((reason == "kept").alias("kept"), reason.alias("reason"))


def slug(name: Column) -> Column:
    """A name that may be a folder's: blanks and slashes are dashes."""
    return F.translate(name, " /", "--")


def archive_url(pattern: str, company: Column, accession: Column, filename: Column) -> Column:
    """The address of a document: {company} without leading zeros, {accession} without dashes, {filename}."""
    parts = {"{company}": F.regexp_replace(company, "^0+(?=.)", ""), "{accession}": F.replace(accession, F.lit("-"), F.lit("")), "{filename}": filename}
    out = F.lit(pattern)
    for name, value in parts.items():
        out = F.replace(out, F.lit(name), value)
    return out


def section_key(form: Column, kind: Column) -> Column:
    """The key of a document that is taken whole."""
    return F.concat(slug(form), F.lit("_"), F.replace(slug(F.upper(kind)), F.lit("."), F.lit("-")), F.lit("_whole"))


def is_target(form: Column, kind: Column) -> Column:
    """Whether a document of a filing is read: all of a correspondence, the form itself, and exhibits that tell something."""
    t = F.upper(F.trim(F.coalesce(kind, F.lit(""))))
    own = F.startswith(t, F.replace(F.upper(form), F.lit("/A"), F.lit("")))
    return _is(form.isin(ALWAYS) | own | t.rlike(NARRATIVE))


def whole_forms(forms: list[tuple[str, bool]], structured: list[str]) -> list[str]:
    """The forms that are taken whole: those in scope (form, with amendments) without a structure of their own, amendments where they count."""
    return sorted({f for form, amended in forms if form not in structured for f in ([form, f"{form}/A"] if amended else [form])})


def is_vote(form: Column, items: Column) -> Column:
    """Whether a filing reports a vote of shareholders."""
    return _is(F.startswith(form, F.lit("8-K")) & F.array_contains(items, VOTE_ITEM))


def record_problem(stop: Column, parsed: Column, text: Column, limit: int) -> Column:
    """Why a model's recorded answer can't be used; null if it can. Cut off before declined, declined before not parsed."""
    cut, declined = stop == "max_tokens", stop == "refusal"
    return F.when(cut, f"hit max_tokens ({limit}), response cut off").when(declined, F.concat(F.lit("model declined: "), F.substring(F.coalesce(text, F.lit("")), 1, 200))).when(parsed.isNull(), "no parsed output")


def without_fence(text: Column) -> Column:
    """JSON text without the code fence around it."""
    t = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    inner = F.substring(t, F.lit(4), F.length(t))
    body = F.when(F.contains(inner, F.lit("\n")), F.substring(inner, F.locate("\n", inner) + 1, F.length(inner))).otherwise(inner)
    return F.when(~F.startswith(t, F.lit("```")), t).otherwise(F.regexp_replace(F.regexp_replace(body, r"(?s)```(?!.*```).*$", ""), r"(?U)^\s+|\s+$", ""))


def is_placeholder(identity: Column) -> Column:
    return _is(identity.rlike(PLACEHOLDER))


def is_ticker(text: Column) -> Column:
    return _is(text.rlike(TICKER))


def span_words(years: Column) -> Column:
    """"five-year"; digits beyond ten."""
    word = F.when(years.between(1, len(YEARS)), F.element_at(F.array(*map(F.lit, YEARS)), F.greatest(F.least(years, F.lit(len(YEARS))), F.lit(1)).cast("int"))).otherwise(years.cast("string"))
    return F.concat(word, F.lit("-year"))


def year_list(years: Column) -> Column:
    """"FY2021, FY2022", in order; "none" for no years."""
    return F.coalesce(F.nullif(F.array_join(F.transform(F.array_sort(years), lambda y: F.concat(F.lit("FY"), y)), ", "), F.lit("")), F.lit("none"))


def amended(form: Column) -> Column:
    return form != base_form(form)
