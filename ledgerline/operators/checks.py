"""The document checks: each rule gives the rows that break it, and a document passes where there are none.

A document is markdown of paragraphs between blank lines. An index has one row for each id that may be cited. A document is taken apart once
(`examined`): its paragraphs with their ids, quotations, figures and marks meet the facts that they cite in one join, and what comes out is
written; every rule and report reads that. Quotations that their paragraph's facts don't hold are looked for in the whole index by an automaton.

Defined cases: a null body has no paragraphs, and its document still misses its headings and its length; ids cited in two paragraphs give a row for each;
repeated rows of an id in the index count as one; where both tables have a column `scope` (whose ledger it is), a document cites the ids of its own scope only, as short ids
of very many ledgers may agree by chance, and quotations are looked for in all of them; other columns of either table are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import canon_text, canonical
from ledgerline.operators.attribution import first_containing
from ledgerline.operators.ledger import FIELD_CODES
from ledgerline.sources.shipping import ship
from ledgerline.sources.stages import Stages

#: The field codes of ids: those of facts, and that of changes in risk factors. Fixed values.
CODES = [*FIELD_CODES.values(), "RISK"]
#: An id of any code in either case, of 8 digits or 16 (`build.named_apart`), one of a known code, and a citation: one id or several in square brackets. Fixed patterns.
ANY_ID = r"\b[A-Za-z]{2,8}-FY\d{4}-[0-9a-f]{8}(?:[0-9a-f]{8})?\b"
KNOWN_ID = rf"(?=[A-Z])\b(?:{'|'.join(sorted(CODES))})-FY\d{{4}}-[0-9a-f]{{8}}(?:[0-9a-f]{{8}})?\b"
GROUP = rf"\[\s*{KNOWN_ID}(?:\s*[,;]\s*{KNOWN_ID})*\s*\]"
#: Where a document's own account of its making begins. Fixed text.
FOOTER = "### Provenance"
#: What flags a paragraph as resting on weak facts, what dates a sentence, what a paragraph about answers speaks of. Fixed patterns.
FLAGS = r"(?i)low[- ]confidence|unverified|indicative|not established|treated as indicative|boundaries are unverified"
DATED = r"\b\d{1,2}\s+\w+\s+20\d\d\b|\b\w+\s+\d{1,2},\s+20\d\d\b|\b20\d\d\b"
SUBJECT = r"(?i)question|answer|investor q&a|reg fd|regulation fd"
#: Three years in a row, each with a number, make a series. Fixed pattern.
SERIES = r"(?:\b20\d\d\b\D{0,20}\b\d+\b\D{0,40}){3,}"
#: The figures of prose, what names something and is no figure, what stands in each such name, and any number of a fact. Fixed patterns.
FIGURE = r"(?U)(?=\d)(?<![\w.])(\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+\.\d+|\d{3,})(?![\w])"
NO_FIGURE = r"(?i)\bItems?\s+\d+(?:\.\d+)?[A-Z]?|\bRule\s+\d+[a-z]?-?\d*|\bSection\s+\d+(?:\.\d+)?|\b(?:Form\s+)?(?:10-[KQ]|8-K(?:/A)?|DEF\s*14A|DEFA\s*14A|SC\s*13[GD])"
NAMES = ["item", "rule", "section", "10-", "8-", "def", "sc"]
NUMBER = r"\d[\d,]*\.?\d*"
#: Numbers of segments in a sentence. Fixed pattern.
SEGMENT_COUNT = r"(?i)\b(?:one|two|three|four|five|six|seven|eight|nine|ten|\d+)\b[^.]{0,40}\b(?:reportable |operating )?segments?\b"
#: What the rules read of a paragraph and its facts; the rest is for readers.
RULED = ["malformed", "said", "marked", "figures", "flagged", "undated", "series", "gap_told", "unknown", "unverified", "low", "letter", "quoted", "claimed", "texts"]
#: The shortest quotation that is looked at, and the share of answers among its citations from which a paragraph rests on them. Fixed values.
SHORTEST_QUOTE, MOSTLY = 4, 0.5


def any_match(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def holds_any(text: Column, words: list[str]) -> Column:
    """Whether a text has one of some words in either case: a plain search before a pattern that needs one of them."""
    return reduce(Column.__or__, (F.contains(F.lower(text), F.lit(w)) for w in words))


def body_of(text: Column) -> Column:
    """A document without its own account of its making."""
    return F.substring_index(text, FOOTER, 1)


def _parts(body: Column) -> Column:
    return F.filter(F.split(body, "\n\n"), lambda p: any_match(p, r"\S"))


def _sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"(?<=[.;:])\s+"), lambda s: F.trim(s)), lambda s: s != "")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc, par, text) of every paragraph, from 0."""
    return docs.select("doc", F.posexplode(_parts(body_of(F.col("body")))).alias("par", "text")).withColumn("par", F.col("par").cast("bigint"))


def sentences(pars: DataFrame) -> DataFrame:
    """(doc, par, text) of the sentences of every paragraph: parted after a full stop, colon or semicolon and white space."""
    return pars.select("doc", "par", F.explode(_sentences(F.col("text"))).alias("text"))


def _ids(text: Column, pattern: str = KNOWN_ID) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def word_count(body: Column) -> Column:
    """Words of a text without its citations."""
    bare = F.regexp_replace(F.regexp_replace(body, GROUP, " "), KNOWN_ID, "")
    return F.regexp_count(bare, F.lit(r"\S+")).cast("bigint")


def normal(number: Column) -> Column:
    """A number without thousands separators and a last ".0"."""
    plain = F.replace(number, F.lit(","), F.lit(""))
    return F.when(plain.endswith(".0"), F.substring(plain, F.lit(1), F.length(plain) - 2)).otherwise(plain)


def numbers(text: Column) -> Column:
    """The distinct numbers of a fact's text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NUMBER), F.lit(0)), normal))


def figures(text: Column) -> Column:
    """The distinct figures of prose: thousands with separators, decimals, numbers of three digits or more; no ids, years, or numbers that name an item, rule, section or form."""
    return _figures(_unnamed(text))


def _unnamed(text: Column) -> Column:
    """A text without ids and names that have numbers."""
    bare = F.regexp_replace(text, KNOWN_ID, "")
    return F.when(holds_any(text, NAMES), F.regexp_replace(bare, NO_FIGURE, " ")).otherwise(bare)


def _figures(unnamed: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(unnamed, F.lit(FIGURE), F.lit(1)), normal), lambda n: ~n.rlike(r"^(?:19|20)\d\d$")))


def quotations(text: Column) -> Column:
    """What stands between double marks, paired from the left, four characters or more."""
    return F.filter(F.regexp_extract_all(text, F.lit('"([^"]+)"'), F.lit(1)), lambda q: F.length(F.trim(q)) >= SHORTEST_QUOTE)


def forms(quote: str) -> list[list[str]]:
    """The ways a quotation may stand in its source, each as the parts that have to be there.

    As it is; without the mark that closes a sentence inside it; with what editors put in brackets, and without. An
    ellipsis parts what is quoted, and is three full stops by then.
    """
    ends = " ,.;:"
    ways = {quote, quote.strip(ends)}
    if "[" in quote:
        ways |= {re.sub(r"\[([^\]]*)\]", kept, quote).strip(ends) for kept in (r"\1", "")}
    folded = {canonical(w).replace("'", '"') for w in ways} - {""}
    return sorted([p for x in way.split("...") if (p := x.strip())] for way in folded)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def quote_forms(quote: pd.Series) -> pd.Series:
    return quote.map(forms, na_action="ignore")


def held(ways: Column, text: Column) -> Column:
    """Whether all parts of one of the ways are in a text."""
    return F.exists(ways, lambda parts: F.forall(parts, lambda p: F.contains(text, p)))


def id_keys(docs: DataFrame, index: DataFrame) -> list[str]:
    """The columns by which cited ids meet the index."""
    return ["scope", "id"] if "scope" in docs.columns and "scope" in index.columns else ["id"]


def citation_report(docs: DataFrame, index: DataFrame) -> DataFrame:
    """doc, n_citations, n_distinct, n_unknown, n_malformed, n_low, n_unverified, by_field (distinct known ids by field) of each document.

    Ids of no known code are malformed and no citations.
    """
    body = body_of(F.col("body"))
    keys = id_keys(docs, index)
    seen = docs.select("doc", *keys[:-1], F.explode(_ids(body)).alias("id")).groupBy("doc", *keys).agg(F.count("*").alias("n"))  # ids are counted before the join
    known = index.select(*keys, "confidence", "quote_verified", F.lit(True).alias("known")).dropDuplicates(keys)
    field = F.coalesce(*(F.when(F.substring_index("id", "-", 1) == code, name) for name, code in FIELD_CODES.items()), F.lit("risk"))
    named = seen.join(known, keys, "left").withColumn("field", F.when(F.col("known"), field))
    by_field = named.groupBy("doc", "field").agg(
        F.sum("n").alias("n_citations"),
        F.count("*").alias("n_distinct"),
        F.count_if(F.col("known").isNull()).alias("n_unknown"),
        F.count_if(F.col("known") & ~F.col("confidence").eqNullSafe("high")).alias("n_low"),
        F.count_if(F.col("known") & (F.col("quote_verified") == F.lit(False))).alias("n_unverified"),
    )
    counts = ["n_citations", "n_distinct", "n_unknown", "n_low", "n_unverified"]
    pairs = F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", "n_distinct")))
    out = by_field.groupBy("doc").agg(*(F.sum(c).alias(c) for c in counts), F.map_from_entries(F.array_sort(pairs)).alias("by_field"))
    malformed = F.size(F.filter(F.array_distinct(_ids(F.coalesce(body, F.lit("")), ANY_ID)), lambda x: ~x.rlike(f"^{KNOWN_ID}$")))
    every = docs.select("doc", malformed.cast("bigint").alias("n_malformed")).join(out, "doc", "left")
    shown = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return every.select("doc", shown("n_citations"), shown("n_distinct"), shown("n_unknown"), "n_malformed", shown("n_low"), shown("n_unverified"), F.coalesce("by_field", F.create_map().cast("map<string,bigint>")).alias("by_field"))


def examined(docs: DataFrame, index: DataFrame, wanted: Collection[str] | None = None, where: Column | None = None) -> DataFrame:
    """The paragraphs with what the rules look at, and what the facts they cite say; written once.

    doc, par, ids, malformed, said, marked (has a quotation mark), figures, flagged, undated, series, gap_told, answers (share of ids that are answers),
    registered, segment_counts; of the cited facts: unknown, unverified (ids), low, letter, quoted, claimed (numbers), texts. Where a caller reads few of
    these, it names them (`wanted`), and by a condition on those of the paragraph the paragraphs that it reads (`where`).
    """
    ship(docs.sparkSession)
    text, x = F.col("text"), F.col
    keys = id_keys(docs, index)
    pars = docs.select("doc", *keys[:-1], "gap_years", "register", F.posexplode(_parts(body_of(x("body")))).alias("par", "text"))
    bare = lambda s: F.regexp_replace(s, ANY_ID, " ")
    told = F.exists(_sentences(text), lambda s: any_match(s, "(?i)letter") & F.exists(F.coalesce("gap_years", F.array().cast("array<int>")), lambda y: F.contains(bare(s), y.cast("string"))))
    every = _ids(text)
    undated = F.exists(_sentences(text), lambda s: F.contains(s, F.lit("VOTE-FY")) & ~any_match(s, DATED))
    segment_counts = F.filter(_sentences(text), lambda s: any_match(s, SEGMENT_COUNT))
    none = F.array().cast("array<string>")
    known = F.filter("any_ids", lambda i: i.rlike(f"^{KNOWN_ID}$"))
    looks = {
        "ids": known,
        "malformed": F.filter("any_ids", lambda i: ~i.rlike(f"^{KNOWN_ID}$")),
        "said": F.when(F.contains(text, F.lit('"')), quotations(text)).otherwise(none), "marked": F.contains(text, F.lit('"')),
        "figures": F.when(F.size(known) > 0, _figures(x("unnamed"))).otherwise(none),
        "flagged": holds_any(text, ["low", "unverified", "indicative", "not established"]) & any_match(text, FLAGS),
        "undated": F.contains(text, F.lit("VOTE-FY")) & undated,
        "series": holds_any(text, ["question", "answer", "investor q&a", "reg fd", "regulation fd"]) & any_match(text, SUBJECT) & any_match(text, SERIES),
        "gap_told": F.when(F.size("gap_years") > 0, told).otherwise(F.lit(False)),
        "answers": F.size(F.filter(every, lambda i: i.startswith("QA-"))) / F.nullif(F.size(every), F.lit(0)),
        "registered": F.regexp_like(text, F.col("register")),
        "segment_counts": F.when(holds_any(text, ["segment"]), segment_counts).otherwise(none),
    }
    letter = F.col("letter") if "letter" in index.columns else F.lit(False)
    says = {
        "low": ~F.col("confidence").eqNullSafe("high"), "unverified": F.col("quote_verified") == F.lit(False), "letter": letter,
        "quoted": numbers(F.col("quote")), "claimed": numbers(F.col("claim")), "texts": fact_text(F.col("quote")),
    }
    gathered = {
        "unknown": F.sort_array(F.collect_list(F.when(F.col("known").isNull(), F.col("id")))), "unverified": F.sort_array(F.collect_list(F.when(F.col("unverified"), F.col("id")))),
        "low": F.coalesce(F.max("low"), F.lit(False)), "letter": F.coalesce(F.max("letter"), F.lit(False)),
        "quoted": F.flatten(F.collect_list("quoted")), "claimed": F.flatten(F.collect_list("claimed")), "texts": F.array_join(F.collect_list("texts"), "\n"),
    }
    few = lambda named: [c.alias(name) for name, c in named.items() if wanted is None or name in {"ids", *wanted}]
    stages = Stages(docs.sparkSession)
    marked = pars.select("*", F.array_distinct(_ids(text, ANY_ID)).alias("any_ids"), _unnamed(text).alias("unnamed"))  # a known id is such an id, too
    looked = marked.select("doc", *keys[:-1], F.col("par").cast("bigint").alias("par"), *few(looks))
    looked = stages.keep(looked if where is None else looked.where(where))
    facts = index.dropDuplicates(keys).select(*keys, F.lit(True).alias("known"), *few(says))
    cited = looked.select("doc", "par", *keys[:-1], F.explode("ids").alias("id")).join(facts, keys, "left")
    return stages.keep(looked.join(cited.groupBy("doc", "par").agg(*few(gathered)), ["doc", "par"], "left"))


def fact_text(quote: Column) -> Column:
    """What may be quoted of a fact, in the form that quotations are compared in."""
    return F.translate(canon_text(F.coalesce(quote, F.lit(""))), "'", '"')


def quote_statuses(seen: DataFrame, index: DataFrame) -> DataFrame:
    """(doc, par, said, status, source_id) of each distinct quotation: ok in the facts that its paragraph cites, elsewhere in the index (source_id has its first part), or bad."""
    stages = Stages(seen.sparkSession)
    said = seen.select("doc", "par", F.explode(F.array_distinct("said")).alias("said"), F.coalesce("texts", F.lit("")).alias("texts")).withColumn("ways", quote_forms("said"))
    judged = stages.keep(said.select("doc", "par", "said", F.when(held(F.col("ways"), F.col("texts")), True).otherwise(False).alias("ok"), "ways"))
    rest = judged.where("not ok").select("said", "ways").dropDuplicates(["said"])
    parts = rest.select("said", F.posexplode("ways").alias("way", "parts")).select("said", "way", F.posexplode_outer("parts").alias("at", "part"))
    texts = index.where("quote is not null").select(F.col("id").alias("source_id"), fact_text(F.col("quote")).alias("text"))
    found = first_containing(parts.select(F.col("part").alias("quote")), texts).withColumnRenamed("quote", "part")
    way = parts.join(found, "part", "left").groupBy("said", "way").agg(F.bool_and(F.col("source_id").isNotNull() | F.col("part").isNull()).alias("all"), F.min_by("source_id", "at").alias("source_id"))
    there = way.where("all").groupBy("said").agg(F.min("source_id").alias("source_id"), F.lit(True).alias("there"))
    status = F.when(F.col("ok"), "ok").when(F.col("there"), "elsewhere").otherwise("bad")
    return judged.join(there, "said", "left").select("doc", "par", "said", status.alias("status"), F.when(~F.col("ok"), F.col("source_id")).alias("source_id"))


def _registered(docs: DataFrame, register: str) -> DataFrame:
    scope = [c for c in ("scope",) if c in docs.columns]
    return docs.select("doc", *scope, "body", "stamped", "current", "gap_years", F.lit(register).alias("register"))


def quote_report(docs: DataFrame, index: DataFrame) -> DataFrame:
    """`quote_statuses` of documents."""
    return quote_statuses(examined(_registered(docs, ""), index, ["said", "texts"], F.size("said") > 0), index)


def tiers(seen: DataFrame) -> DataFrame:
    """(doc, par, figure, tier): in a cited quotation (quoted), only in a cited claim (thin), or in neither (unsourced). Only paragraphs with citations have figures."""
    tier = lambda f: F.when(F.array_contains("quoted", f), "quoted").when(F.array_contains("claimed", f), "thin").otherwise("unsourced")
    return seen.select("doc", "par", F.explode(F.transform("figures", lambda f: F.struct(f.alias("figure"), tier(f).alias("tier")))).alias("t")).select("doc", "par", "t.*")


def violations(docs: DataFrame, index: DataFrame, headings: list[str], words: tuple[int, int], register: str) -> DataFrame:
    """(doc, rule, detail) of every broken rule.

    `docs`: doc, body, stamped, current (pack hashes), gap_years (years without a letter). `index`: id, confidence, quote_verified, quote, claim, and
    letter (whether the fact comes from one; without that column none does). `headings` have to be there in either case, `words` bound the
    length, the pattern `register` has to be found before the first cited answer.
    """
    register = f"(?i){register}"
    seen = examined(_registered(docs, register), index, RULED)
    x = F.col
    broken = lambda rule, detail: F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))
    when = lambda cond, rule, detail: F.array(F.when(cond, broken(rule, detail)))
    each = lambda values, rule: F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: broken(rule, v))
    listed = lambda df, *rules: df.select("doc", F.explode(F.array_compact(F.flatten(F.array(*rules)))).alias("v")).select("doc", "v.*")
    par = F.concat(F.lit("paragraph "), x("par"))
    by_paragraph = listed(
        seen,
        each(x("unknown"), "ids_resolve"),
        each(x("malformed"), "ids_wellformed"),
        F.when(x("marked"), each(x("unverified"), "no_unverified_quoted")).otherwise(F.array().cast("array<struct<rule:string,detail:string>>")),
        when(x("low") & ~x("flagged"), "low_conf_flagged", par),
        when(x("undated"), "vote_dated", par),
        when(x("series"), "qa_not_a_series", par),
        each(F.array_except(F.array_except("figures", F.coalesce("quoted", F.array().cast("array<string>"))), F.coalesce("claimed", F.array().cast("array<string>"))), "figures_evidenced"),
    )
    body = F.coalesce(body_of(x("body")), F.lit(""))
    n = word_count(body)
    first_answer, first_register = F.regexp_instr(body, F.lit(r"\bQA-FY")), F.regexp_instr(body, F.lit(register))
    by_document = listed(
        docs,
        when(x("stamped").isNull(), "prov_present", F.lit("no pack hash")),
        when(x("stamped") != x("current"), "prov_matches", x("stamped")),
        when(F.contains(body, F.lit("QA-FY")) & (first_answer > 0) & ((first_register == 0) | (first_register >= first_answer)), "reg_fd_established", F.lit(register)),
        *(when(~F.contains(F.lower(body), F.lit(h.lower())), "sections_present", F.lit(h)) for h in headings),
        when((n < words[0]) | (n > words[1]), "length", n),
    )
    letters = seen.groupBy("doc").agg(F.max("letter").alias("letter"), F.max("gap_told").alias("told")).where("letter and not told")
    gaps = docs.where("size(gap_years) > 0").join(letters, "doc").select("doc", F.lit("letter_gap_named").alias("rule"), F.concat_ws(", ", F.transform("gap_years", lambda y: y.cast("string"))).alias("detail"))
    quoted = quote_statuses(seen, index).where("status <> 'ok'").select("doc", F.lit("quotes_verbatim").alias("rule"), F.concat_ws(": ", "status", "said").alias("detail"))
    return reduce(DataFrame.union, [by_paragraph, by_document, gaps, quoted])


def reviews(docs: DataFrame, index: DataFrame, register: str, product_years: list[int], segment_years: list[int]) -> DataFrame:
    """(doc, par, list, detail) for a reader, never a failure: counts of segments compared across a change of what is counted (years of
    `product_years` and `segment_years` in one sentence), figures that only a claim has, paragraphs that rest mostly on answers and don't name the register."""
    seen = examined(_registered(docs, f"(?i){register}"), index)
    any_year = lambda s, years: F.arrays_overlap(F.regexp_extract_all(s, F.lit(r"\b(20\d\d)\b"), F.lit(1)), F.array(*(F.lit(str(y)) for y in years)).cast("array<string>"))
    both = F.filter("segment_counts", lambda s: any_year(s, product_years) & any_year(s, segment_years))
    shown = lambda df, name, detail: df.select("doc", "par", F.lit(name).alias("list"), detail.alias("detail"))
    counted = shown(seen.select("doc", "par", F.explode(both).alias("s")), "segment counts", F.substring("s", 1, 200))
    thin = shown(tiers(seen).where("tier = 'thin'"), "thin figure", F.col("figure"))
    mostly = shown(seen.where((F.col("answers") >= MOSTLY) & ~F.coalesce("registered", F.lit(False))), "mostly answers", F.round("answers", 4).cast("string"))
    return counted.union(thin).union(mostly)


def must_hold(found: DataFrame) -> None:
    """Raise if a rule is broken: for use before a write."""
    if rows := found.limit(20).collect():  # an error message shows some
        raise ValueError("; ".join(f"{r['doc']}: {r['rule']} ({r['detail']})" for r in rows))
