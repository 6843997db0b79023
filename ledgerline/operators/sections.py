"""Sections of documents given as rows of text nodes: headings, spans between them, and whether a section can be relied on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import substantive_words

#: The least characters of a whole document that was read. Fixed value.
WHOLE_FLOOR = 120


def headings(nodes: DataFrame, text: str, in_link: str, pattern: str, longest: int) -> DataFrame:
    """`nodes` with `item`: group 1 of the pattern in upper case where a node is a heading (not in a link, no longer than `longest`), else null."""
    found = F.upper(F.regexp_extract(F.col(text), pattern, 1))
    is_heading = F.col(text).rlike(pattern) & (F.length(text) <= longest) & ~F.coalesce(F.col(in_link), F.lit(False))
    return nodes.withColumn("item", F.when(is_heading, found))


def spans(nodes: DataFrame, doc: str, order: str, text: str) -> DataFrame:
    """(doc, item, start_ord, end_ord, n_chars) from each heading to the node before the next heading or the document's end.

    Nodes before the first heading belong to no span, null texts have no characters. One running count over a document's nodes
    numbers the spans; the rest is a grouped aggregate.
    """
    running = nodes.select(F.col(doc).alias("doc"), F.col(order).alias("at"), "item", F.col(text).alias("said")).withColumn("span", F.count("item").over(Window.partitionBy("doc").orderBy("at")))
    chars = F.coalesce(F.sum(F.length("said")), F.lit(0)).cast("bigint")
    out = running.where("span > 0").groupBy("doc", "span").agg(F.max("item").alias("item"), F.min("at").alias("start_ord"), F.max("at").alias("end_ord"), chars.alias("n_chars"))
    return out.drop("span").withColumnRenamed("doc", doc)


def chosen_span(found: DataFrame, doc: str, floor: int) -> DataFrame:
    """One span for each document and item: the first with `floor` characters, else the largest, the first of equal ones.

    So the entry of a table of contents, which the next entry follows at once, is never taken for the section. `basis` says which it was.
    """
    full = F.col("n_chars") >= floor
    first = F.min_by(F.struct("start_ord", "end_ord", "n_chars"), F.when(full, F.col("start_ord")))
    largest = F.min_by(F.struct("start_ord", "end_ord", "n_chars"), F.struct(-F.col("n_chars"), F.col("start_ord")))
    picked = found.groupBy(doc, "item").agg(F.count("*").alias("n_candidates"), F.max(full).alias("ok"), first.alias("first"), largest.alias("largest"))
    return picked.select(doc, "item", "n_candidates", F.coalesce("first", "largest").alias("s"), F.when(F.col("ok"), "first over the floor").otherwise("largest").alias("basis")).select(doc, "item", "n_candidates", "s.*", "basis")


def section_problems(text: Column, floor: int, words: int, anchors: list[str], n_anchors: int, overrun: list[str], band: tuple[int, int] | None = None, whole: Column | None = None) -> Column:
    """What is wrong with a section's text, as an array of texts. Null texts are empty.

    Fewer than `floor` characters; fewer words than `words`; outside the band of the section; fewer than `n_anchors` of its anchor phrases, in either case;
    or run past its end: one pattern of `overrun` three times, or two of them (one mention is a reference, not an overrun).
    `whole`: where true, the text is a whole document, which has a floor of WHOLE_FLOOR and neither band nor end.
    """
    said, entire = F.coalesce(text, F.lit("")), F.coalesce(whole, F.lit(False)) if whole is not None else F.lit(False)
    n, n_words, low = F.length(said), substantive_words(said), F.lower(said)
    least = F.when(entire, F.lit(WHOLE_FLOOR)).otherwise(F.lit(floor))
    present = F.size(F.filter(F.array(*map(F.lit, anchors)).cast("array<string>"), lambda a: F.contains(low, F.lower(a))))
    times = F.array(*(F.struct(F.lit(p).alias("p"), F.regexp_count(said, F.lit(f"(?i){p}")).alias("n")) for p in overrun)).cast("array<struct<p:string,n:int>>")
    met = F.filter(times, lambda t: t["n"] > 0)
    past = ~entire & ((F.size(met) >= 2) | F.exists(met, lambda t: t["n"] >= 3))
    sizes = [F.when(~entire & (n < band[0]), F.concat(F.lit("shorter than expected: "), n)), F.when(~entire & (n > band[1]), F.concat(F.lit("longer than expected: "), n))] if band else []
    return F.array_compact(F.array(
        F.when(n < least, F.concat(F.lit("characters: "), n)),
        F.when(n_words < words, F.concat(F.lit("words: "), n_words)),
        *sizes,
        F.when(present < n_anchors, F.concat(F.lit("anchors: "), present)),
        F.when(past, F.concat(F.lit("overrun: "), F.array_join(F.transform(met, lambda t: F.concat(t["p"], F.lit(" x"), t["n"])), ", "))),
    ))


#: The least characters of a heading of a risk factor or of a category. Fixed value.
LEAST_HEADING = 20


def readable(parts: Column) -> Column:
    """The text of nodes in order (array of struct(ord, text, block)): one space between nodes of a block, a line break between blocks."""
    start = F.struct(F.lit("").alias("text"), F.lit(None).cast("bigint").alias("block"))
    joined = F.aggregate(F.filter(F.array_sort(parts), lambda p: p["text"] != ""), start, lambda acc, p: F.struct(F.concat(acc["text"], F.when(acc["block"].isNull(), "").when(acc["block"] == p["block"], " ").otherwise("\n"), p["text"]).alias("text"), p["block"].alias("block")))
    return stripped(F.regexp_replace(joined["text"], r"[ \t]+", " "))


def stripped(text: Column) -> Column:
    """A text without white space at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def span_text(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, text of each span, from nodes with the columns `keys`, ord, text, block. A span's text is one row, as it is one in what comes after."""
    return nodes.groupBy(*keys).agg(F.collect_list(F.struct("ord", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("block", F.lit(0)).cast("bigint").alias("block"))).alias("parts")).select(*keys, readable(F.col("parts")).alias("text"))


def risk_factors(nodes: DataFrame) -> DataFrame:
    """doc, ord, heading, category, body, body_chars, was_split of the risk factors in the nodes (doc, ord, text, bold, italic, block) of a section.

    A bold and italic text of LEAST_HEADING characters heads a factor, a bold one a category of those that follow. What stands up to the
    next heading is the body. A factor without a body is the first part of the heading of the next one, and so on.
    """
    marked = F.col("bold") & (F.length("text") >= LEAST_HEADING)
    kind = F.when(marked & F.col("italic"), "factor").when(marked, "category")
    by_doc = Window.partitionBy("doc").orderBy("ord")
    numbered = nodes.select("doc", "ord", "text", "block", kind.alias("kind")).withColumn("span", F.count("kind").over(by_doc)).where("span > 0")
    said = span_text(numbered, ["doc", "span"])
    heads = numbered.where("kind is not null").withColumn("category", F.last(F.when(F.col("kind") == "category", F.col("text")), True).over(by_doc)).where("kind = 'factor'")
    spans = heads.select("doc", "span", "ord", F.col("text").alias("heading"), "category").join(said, ["doc", "span"])
    body = F.when(F.startswith("text", "heading"), stripped(F.substring(F.col("text"), F.length("heading") + 1, F.length("text")))).otherwise(F.col("text"))
    factors = spans.withColumn("body", body)
    ended = F.coalesce(F.sum((F.length("body") > 0).cast("int")).over(by_doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    grouped = factors.withColumn("island", ended).groupBy("doc", "island").agg(F.array_sort(F.collect_list(F.struct("ord", "heading", "category", "body"))).alias("f"))
    whole = F.array_join(F.transform("f", lambda x: x["heading"]), " ")
    first = F.array_compact(F.transform("f", lambda x: x["category"]))
    last = F.element_at("f", -1)
    return grouped.select("doc", last["ord"].alias("ord"), whole.alias("heading"), F.get(first, F.lit(0)).alias("category"), last["body"].alias("body"), F.length(last["body"]).alias("body_chars"), (F.size("f") > 1).alias("was_split"))


def without_text(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """doc, reason of the documents that gave nothing: rows of their own, so that one bad document stops no other."""
    read = nodes.groupBy("doc").agg(F.count("*").alias("n"))
    reason = F.when(F.col("html").isNull(), "no document").when(F.trim("html") == "", "empty document").otherwise("no text in the document")
    return docs.select("doc", "html").join(read, "doc", "left").where("n is null").select("doc", reason.alias("reason"))
