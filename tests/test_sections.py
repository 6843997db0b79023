"""Sections, outcomes of matched lists and calendar reports on small made tables."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.functions import tables, text
from ledgerline.functions.register import register
from ledgerline.operators import graph, matching, outcomes, sections


def test_a_table_of_contents_is_not_the_section(spark):
    rows = [(1, 0, "cover", False), (1, 1, "Item 1a. Risks", False), (1, 2, "Item 7. Results", False), (1, 3, "Item 1A. Risks", True), (1, 4, "Item 1A. Risks", False), (1, 5, "x" * 50, False), (1, 6, None, None), (1, 7, "Item 7. Results", False), (1, 8, "y" * 5, False), (2, 0, None, None)]
    nodes = spark.createDataFrame(rows, "doc int, at int, said string, link boolean")
    marked = sections.headings(nodes, "said", "link", r"^Item (\d+[a-zA-Z]?)\.", 40)
    found = sections.spans(marked, "doc", "at", "said")
    got = {(r.doc, r.item): (r.start_ord, r.end_ord, r.n_candidates, r.basis) for r in sections.chosen_span(found, "doc", 40).collect()}
    # item 7 has no span over the floor; its first one runs up to the next heading outside a link
    assert got == {(1, "1A"): (4, 6, 2, "first over the floor"), (1, "7"): (2, 3, 2, "largest")}
    assert sections.spans(marked.limit(0), "doc", "at", "said").count() == 0


@pytest.mark.parametrize(
    "text,whole,want",
    [
        (None, False, ["characters: 0", "words: 0", "shorter than expected: 0", "anchors: 0"]),
        ("risk factors are many words that go on", False, []),
        ("Risk in a chart.jpg", False, ["characters: 19", "words: 2", "shorter than expected: 19", "anchors: 1"]),
        ("risk factors, see our consolidated balance sheets, go on and on", False, []),
        ("risk factors " + "CONSOLIDATED BALANCE  SHEET " * 3 + "go on", False, ["overrun: consolidated\\s*balance\\s*sheets? x3"]),
        ("risk factors in notes to the statements, consolidated balance sheets", False, ["overrun: consolidated\\s*balance\\s*sheets? x1, notes\\s+to x1"]),
        ("risk factors " * 30, False, ["longer than expected: 390"]),
        ("risk factors in notes to the statements, consolidated balance sheets" * 9, True, []),
        ("risk factors are many words that go on", True, ["characters: 38"]),
    ],
)
def test_section_problems(spark, text, whole, want):
    found = sections.section_problems(F.col("t"), 30, 6, ["RISK", "factors"], 2, [r"consolidated\s*balance\s*sheets?", r"notes\s+to"], (30, 300), F.col("w"))
    assert list(spark.createDataFrame([(text, whole)], "t string, w boolean").select(found).first()[0]) == want


def test_outcomes_add_up(spark):
    now = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "k string, ord int")
    prior = spark.createDataFrame([("a", 1), ("a", 2), ("c", 9)], "k string, ord int")
    pairs = spark.createDataFrame([("a", 1, 2, 100.0, 95.0), ("a", 2, 1, 100.0, None)], "k string, left_ord int, right_ord int, score double, body_score double")
    out = outcomes.match_outcome(now, prior, pairs, "k", 95, 90)
    assert {(r.k, r.left_ord, r.right_ord, r.outcome, r.changed) for r in out.collect()} == {("a", 1, 2, "unchanged", None), ("a", 2, 1, "reworded", "body only"), ("a", 3, None, "added", None), ("b", 1, None, "added", None), ("c", None, 9, "removed", None)}
    problems = lambda o: {tuple(r) for r in outcomes.outcome_problems(o, now, prior, "k").collect()}
    assert problems(out) == {("b", "nothing matched")}
    assert ("a", "current list does not add up") in problems(out.where("outcome <> 'added'"))
    assert outcomes.match_outcome(now.limit(0), prior.limit(0), pairs.limit(0), "k", 95, 90).count() == 0


def test_list_diff_is_chained(spark):
    long = "we may lose customers if our service does not keep up with their needs"
    now = [("a", 0, long, "body one of many words"), ("a", 1, "a new risk about the weather", "x"), ("a", 2, "our systems may fail at any time", "entirely other words here"), ("b", 0, "alone", None)]
    prior = [("a", 5, "with their needs we may lose customers if our service does not keep up", "body one of many words"), ("a", 6, "our systems might fail at any time", "the text of before"), ("a", 7, "gone now", "y")]
    kind = "block string, ord int, heading string, body string"
    diffs = outcomes.list_diff(spark.createDataFrame(now, kind), spark.createDataFrame(prior, kind), "block")
    got = {(r.block, r.left_ord, r.right_ord): (r.outcome, r.changed, r.heading_score, r.body_score) for r in diffs.collect()}
    score = lambda a, b: round(text.token_sort(a, b), 1)
    assert got == {
        ("a", 0, 5): ("unchanged", None, 100.0, 100.0), ("a", 2, 6): ("reworded", "heading and body", score(now[2][2], prior[1][2]), score(now[2][3], prior[1][3])),
        ("a", 1, None): ("added", None, None, None), ("b", 0, None): ("added", None, None, None), ("a", None, 7): ("removed", None, None, None),
    }
    assert {tuple(r) for r in outcomes.category_counts(diffs, "block").collect()} == {("a", 1, 1, 1, 1), ("b", 0, 0, 1, 0)}


def test_calendar_reports(spark):
    filings = spark.createDataFrame([(2020, dt.date(2020, 6, 25)), (2020, dt.date(2020, 7, 15)), (2022, None)], "year int, report date")
    assert sorted(r.year for r in outcomes.missing_years(filings, "year", 2019, 2022).collect()) == [2019, 2021]
    assert [tuple(r) for r in outcomes.off_rhythm(filings, "year", 2).collect()] == [(2022, 1)]
    assert [r.drift for r in outcomes.year_end_drift(filings, "report", 6, 30).collect()] == [15]
    feb = spark.createDataFrame([(dt.date(2021, 2, 28),), (dt.date(2020, 2, 20),)], "report date")
    assert [r.drift for r in outcomes.year_end_drift(feb, "report", 2, 29).collect()] == [-9]


def test_the_one_row(spark):
    df = spark.createDataFrame([("ab", 1), ("AB", 2), ("c", 3), (None, 4)], "name string, n int")
    assert outcomes.the_one(df, "name", "C").first().n == 3
    for value in ("Ab", "d"):
        with pytest.raises(LookupError):
            outcomes.the_one(df, "name", value)


def test_functions_in_sql(spark):
    register(spark)
    r = spark.sql("SELECT token_sort_ratio('b a', 'a b') AS s, token_set_ratio('a b b', 'b a') AS t, canon_text('x  “y”') AS c").first()
    assert (r.s, r.t, r.c) == (100.0, 100.0, 'x "y"')


def plain_factors(rows):
    """The split by a loop over (text, bold, italic, block)."""
    marks = [(k, "factor" if i else "category", t) for k, (t, b, i, _) in enumerate(rows) if b and len(t) >= sections.LEAST_HEADING]
    out, category = [], None
    for j, (k, kind, heading) in enumerate(marks):
        if kind == "category":
            category = heading
            continue
        text, last = "", None
        for t, _, _, block in rows[k : marks[j + 1][0] if j + 1 < len(marks) else len(rows)]:
            if t:
                text += ("" if last is None else " " if last == block else "\n") + t
                last = block
        f = [heading, category, text[len(heading) :].strip(), False]
        if out and not out[-1][2]:
            before = out.pop()
            f = [f"{before[0]} {heading}", before[1] or category, f[2], True]
        out.append(f)
    return out


def test_risk_factors_equal_a_loop(spark):
    rng = random.Random(5)
    docs = {}
    for d in range(40):
        rows = []
        for k in range(rng.randint(0, 25)):
            bold = rng.random() < 0.5
            rows.append((rng.choice(["", "short", f"A heading number {k} of the risks", f"words {k}"]) if bold else f"body text {k}", bold, bold and rng.random() < 0.7, k // rng.choice([1, 2, 3])))
        docs[d] = rows
    df = spark.createDataFrame([(d, k, *r) for d, rows in docs.items() for k, r in enumerate(rows)], "doc int, ord int, text string, bold boolean, italic boolean, block bigint")
    got = {}
    for r in sections.risk_factors(df).orderBy("doc", "ord").collect():
        got.setdefault(r.doc, []).append([r.heading, r.category, r.body, r.was_split])
        assert r.body_chars == len(r.body)
    assert got == {d: f for d, rows in docs.items() if (f := plain_factors(rows))}
    assert sections.risk_factors(df.limit(0)).count() == 0


PAGE = """<div><p style="font-weight:bold">Risks about our business in general</p>
<p><span style="font-weight:700; font-style:italic">We may lose customers if our service</span></p>
<p><span style="font-weight:700; font-style: italic">does not keep up with their needs.</span></p>
<p>They may <a href="#">leave</a> us.</p><p>And <b>soon</b>.</p>
<div style="font-weight:bold"><p><span><span><span><i>too far from the bold element to be</i></span></span></span></p></div></div>"""


def test_factors_of_a_page_in_one_plan(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, " "), (4, "<p></p>")], "doc int, html string")
    nodes = matching.html_nodes(pages, "doc", "html")
    got = sections.risk_factors(nodes).collect()
    assert [(r.heading, r.category, r.body, r.was_split) for r in got] == [("We may lose customers if our service does not keep up with their needs.", "Risks about our business in general", "They may leave us.\nAnd soon .\ntoo far from the bold element to be", True)]
    assert {r.doc: r.reason for r in sections.without_text(pages, nodes).collect()} == {2: "no document", 3: "empty document", 4: "no text in the document"}


def test_table_functions_give_the_rows_of_the_dataframe_forms(spark):
    tables.register(spark)
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<a>x</a>")], "id int, html string")
    pages.createOrReplaceTempView("some_pages")
    got = spark.sql("SELECT * FROM html_nodes(TABLE(some_pages) PARTITION BY id)")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, matching.html_nodes(pages, "id", "html").collect()), key=str)
    lists = [("k", "left", 1, "a b c"), ("k", "left", 2, "x y"), ("k", "right", 7, "c b a"), ("k", "right", 8, "x z"), ("m", "left", 1, "a"), ("m", "right", 3, None)]
    df = spark.createDataFrame(lists, "block string, side string, id bigint, text string")
    df.createOrReplaceTempView("lists")
    got = spark.sql("SELECT * FROM greedy_match(TABLE(lists) PARTITION BY block ORDER BY id, floor => 60)")
    want = matching.greedy_match(df.where("side = 'left'"), df.where("side = 'right'"), "block", "id", "text", 60)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    edges = spark.createDataFrame([("a", 1, 2), ("a", 3, 2), ("b", 5, 5), ("b", None, 1)], "block string, a int, b int")
    edges.createOrReplaceTempView("edges")
    got = spark.sql("SELECT * FROM components(TABLE(edges) PARTITION BY block)")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, graph.components_in_blocks(edges).collect()))
    with pytest.raises(AnalysisException, match="no column b; it has block, a"):
        spark.sql("SELECT * FROM components(TABLE(SELECT block, a FROM edges) PARTITION BY block)")
