"""Reference semantics on small fixtures."""

import datetime as dt
import hashlib
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import quotes
from ledgerline.functions import text as tx
from ledgerline.operators import checks, fiscal, ledger, matching
from ledgerline.operators import relational as rel
from ledgerline.plans import catalogue


@pytest.mark.parametrize("month,day", [(12, 31), (1, 31), (3, 31), (6, 30), (9, 30), (2, 29)])
def test_fiscal_year_of_every_day(spark, month, day):
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=k) for k in range(731)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", fiscal.containing(F.col("d"), month, day).alias("fy"), fiscal.completed(F.col("d"), month, day).alias("done")).collect()
    for r in got:
        try:
            end = dt.date(r.d.year, month, day)
        except ValueError:
            end = dt.date(r.d.year, month, 28)
        assert r.fy == (r.d.year if r.d <= end else r.d.year + 1)
        assert r.done == r.fy - 1


def test_period_tolerance(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 2),), (dt.date(2022, 1, 10),), (dt.date(2022, 1, 11),), (None,)], "d date")
    assert [r[0] for r in df.select(fiscal.from_period(F.col("d"), 12, 31)).collect()] == [2021, 2021, None, None]


def test_pairing(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    rows = [(1, 1, "v", t(0)), (1, 2, "p", t(1)), (1, 3, "v", t(2)), (1, 4, "p", t(3)), (1, 5, "p", t(4)), (1, 6, "v", t(5)), (2, 7, "p", t(1))]
    df = spark.createDataFrame(rows, "k int, id int, kind string, at timestamp")
    got = {r.left_id: (r.right_id, r.gap_reason) for r in rel.asof_forward(df, "k", "at", F.col("kind") == "p", F.col("kind") == "v", "id").collect()}
    assert got == {2: (3, None), 4: (None, "only after the next one"), 5: (6, None), 7: (None, "no later row")}


def test_islands_chain(spark):
    df = spark.createDataFrame([(1, 1, ""), (1, 2, ""), (1, 3, "x"), (1, 4, "y"), (1, 5, "")], "k int, o int, body string")
    got = rel.island_ids(df, "k", ["o"], F.col("body") != "", "g").orderBy("o").collect()
    assert [r.g for r in got] == [0, 0, 0, 1, 2]


def test_corrections_audit(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, v string")
    fixes = spark.createDataFrame([(1, "a", "z"), (2, "b", "y"), (3, "c", "x")], "id int, expected string, new_value string")
    patched, audit = rel.apply_corrections(df, fixes, "id", "v", "v")
    assert sorted(r.v for r in patched.collect()) == ["y", "y", "z"]
    assert {r.id: r.n_matches for r in audit.collect()} == {1: 1, 2: 2, 3: 0}


SOURCE = "The board approved a new dividend policy in March, and it’s expected to   continue for the coming year."


@pytest.mark.parametrize(
    "quote,holds",
    [
        ("The board approved a new dividend policy in March", True),
        ("the board  approved a new dividend policy in march, and it's expected", True),
        ("and it\\u2019s expected to continue for the coming year", True),
        ("expected to continue for the coming year.xy", True),
        ("The board rejected every dividend policy in March", False),
        ("The board approved a new dividend policy in April and June", False),
        ("new dividend", False),
    ],
)
def test_quotes(quote, holds):
    assert quotes.judge_quote(quote, tx.canonical(SOURCE))[0] is holds
    assert quotes.Canonical(quote).text == tx.canonical(quote)


def test_ratios():
    assert tx.indel_ratio("ab", "ac") == 50
    assert tx.token_sort("Risk of loss", "loss of RISK") == 100
    assert tx.token_set("new chief officer", "new chief officer named today") == 100
    assert tx.token_set("alpha beta", "gamma delta") < 55
    for a, b in [("kitten", "sitting"), ("", "x"), ("abcabc", "bca")]:
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert tx.common_length(a, b) == table[-1][-1]


def test_greedy_ties_take_the_later():
    assert matching.greedy([(0, "a b"), (1, "a b")], [(0, "a b"), (1, "b a")], 60) == [(1, 1, 100.0), (0, 0, 100.0)]
    assert matching.greedy([(0, "x")], [(0, "y")], 60) == []


def test_html_nodes(spark):
    page = "<h2>Item <b>1</b></h2><p>See <a href='#'>link</a> <i>now</i><script>x</script>"
    got = matching.html_nodes(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), "id", "html").orderBy("ord").collect()
    assert [(r.text, r.in_link, r.bold, r.italic, r.heading) for r in got] == [("Item", False, False, False, "h2"), ("1", False, True, False, "h2"), ("See", False, False, False, None), ("link", True, False, False, None), ("now", False, False, True, None)]


def test_positions_over_all_rows(spark):
    rows = [(None if k % 5 == 0 else k % 3 == 0, None if k % 7 == 0 else f"d{k * 37 % 50}", k * 7919 % 1000) for k in range(1000)]
    df = spark.createDataFrame(rows, "g boolean, d string, k bigint")
    got = {r.k: r.n for r in rel.positions(df, "g", ["d", "k"], "n").collect()}
    want = {}
    for g in (None, False, True):
        own = sorted((r for r in rows if r[0] is g), key=lambda r: (r[1] is not None, r[1] or "", r[2]))
        want |= {r[2]: n for n, r in enumerate(own, 1)}
    assert got == want


def test_timeline_has_all_orders(spark):
    from ledgerline.plans import catalogue

    folder = "/root/testdata/sf0.001"
    assert catalogue.QUERIES["timeline_order"](spark, folder).count() == spark.read.parquet(f"{folder}/orders.parquet").count()


DOC = """# Brief

The company plans growth [SP-FY2021-aaaaaaaa]. It has no letter for 2020.

Under Regulation FD the answer was "we expect a good year ahead" [QA-FY2021-bbbbbbbb].

On 2021-05-04 holders voted [VOTE-FY2021-cccccccc]; with low confidence, sales were $1,250.0 [EVT-FY2021-dddddddd]."""
INDEX = [("SP-FY2021-aaaaaaaa", "high", True, "plans growth", None, True), ("QA-FY2021-bbbbbbbb", "high", True, "and we expect a good year ahead, he said", None, False), ("VOTE-FY2021-cccccccc", "high", True, "voted", None, False), ("EVT-FY2021-dddddddd", "low", False, "sales were 1250", None, False), ("EVT-FY2021-eeeeeeee", "high", True, "another source of words", "claims 777 units", None)]
INDEX_KIND = "id string, confidence string, quote_verified boolean, quote string, claim string, letter boolean"
DOCS_KIND = "doc int, body string, stamped string, current string, gap_years array<int>"


@pytest.mark.parametrize(
    "rule,change",
    [
        (None, lambda r: r),
        ("prov_present", lambda r: {**r, "stamped": None}),
        ("prov_matches", lambda r: {**r, "stamped": "old"}),
        ("ids_resolve", lambda r: {**r, "body": r["body"] + " [EVT-FY2021-12345678]"}),
        ("ids_wellformed", lambda r: {**r, "body": r["body"] + " [evt-FY2021-dddddddd]"}),
        ("quotes_verbatim", lambda r: {**r, "body": r["body"].replace("a good year", "a bad year")}),
        ("quotes_verbatim", lambda r: {**r, "body": r["body"].replace("we expect a good year ahead", "source of words")}),
        ("no_unverified_quoted", lambda r: {**r, "body": r["body"].replace("holders voted", 'holders "voted"')}),
        ("low_conf_flagged", lambda r: {**r, "body": r["body"].replace("with low confidence, ", "")}),
        ("vote_dated", lambda r: {**r, "body": r["body"].replace("On 2021-05-04 h", "H")}),
        ("reg_fd_established", lambda r: {**r, "body": r["body"].replace("Regulation FD", "the rule")}),
        ("qa_not_a_series", lambda r: {**r, "body": r["body"].replace("Under Regulation FD", "Answers in 2019: 11, 2020: 12, 2021: 13, and under Regulation FD")}),
        ("letter_gap_named", lambda r: {**r, "body": r["body"].replace("2020", "that year")}),
        ("letter_gap_named", lambda r: {**r, "body": r["body"].replace("no letter for 2020", "a letter [SP-FY2020-aaaaaaaa], not one in 2020").replace("[SP-FY2020-aaaaaaaa], not one in 2020", "[SP-FY2021-aaaaaaaa]")}),
        (None, lambda r: {**r, "body": r["body"].replace("2020", "that year").replace(" [SP-FY2021-aaaaaaaa]", "")}),
        (None, lambda r: {**r, "body": r["body"].replace("2020", "that year"), "gap_years": []}),
        (None, lambda r: {**r, "body": r["body"] + "\n\nRevenue was 12,345 with no citation here."}),
        (None, lambda r: {**r, "body": r["body"] + "\n\nUnder Item 402, Rule 144 and Form 10-K, $5 in 2019 [EVT-FY2021-eeeeeeee]."}),
        (None, lambda r: {**r, "body": r["body"] + "\n\n### Provenance\n\n9,999 ids [EVT-FY2021-12345678]"}),
        (None, lambda r: {**r, "body": r["body"].replace("# Brief", "# BRIEF")}),
        ("sections_present", lambda r: {**r, "body": r["body"].replace("# Brief", "# Other")}),
        ("length", lambda r: {**r, "body": r["body"] + " more words" * 60}),
        ("figures_evidenced", lambda r: {**r, "body": r["body"] + "\n\nIt had 777 units [EVT-FY2021-eeeeeeee] and 888 more."}),
    ],
)
def test_one_mutation_breaks_one_rule(spark, rule, change):
    row = change({"doc": 1, "body": DOC, "stamped": "x", "current": "x", "gap_years": [2020]})
    docs = spark.createDataFrame([tuple(row.values())], DOCS_KIND)
    index = spark.createDataFrame(INDEX, INDEX_KIND)
    broken = checks.violations(docs, index, ["# Brief"], (10, 100), "Regulation FD")
    assert {r.rule for r in broken.collect()} == ({rule} if rule else set())
    if rule:
        with pytest.raises(ValueError):
            checks.must_hold(broken)


def plain_status(said, own, every):
    """By itself: each way of reading a quotation, each of its parts in the facts' texts."""
    folded = lambda t: tx.canonical(t).replace("'", '"')
    for way in {said, said.strip(" ,.;:"), re.sub(r"\[([^\]]*)\]", r"\1", said).strip(" ,.;:"), re.sub(r"\[([^\]]*)\]", "", said).strip(" ,.;:")}:
        parts = [p.strip() for p in re.split(r"…|\.\.\.", folded(way)) if p.strip()]
        if folded(way) and all(any(p in folded(t) for t in own) for p in parts):
            return "ok"
    for way in {said, said.strip(" ,.;:"), re.sub(r"\[([^\]]*)\]", r"\1", said).strip(" ,.;:"), re.sub(r"\[([^\]]*)\]", "", said).strip(" ,.;:")}:
        parts = [p.strip() for p in re.split(r"…|\.\.\.", folded(way)) if p.strip()]
        if folded(way) and all(any(p in folded(t) for t in every) for p in parts):
            return "elsewhere"
    return "bad"


def test_quotations_equal_brute_force(spark):
    texts = ["and we expect a good year ahead, he said", "margins rose to 12.5% - up [slightly] on 2021", "Ab it's “well-run” … they say", "we really expect", None, "a thing"]
    ids = [f"EVT-FY2021-{k:08x}" for k in range(len(texts))]
    said = ["we expect a good", "e expect a goo", "to 12", "rose to 12.5% – up", "[M]argins rose ... on 2021", "expect an awful year", "zz top", "... [x] ...", "“well-run”", "a good year [for us] ahead", "year nowhere ahead", "[W]e expect", "we [really] expect", "we expect … behind", "We  expect a good year,", "it‘s ", "good year ... really expect", "abc", " x ", "12.5% - up slightly"]
    body = "\n\n".join(f'He said "{q}" there [{ids[k % 3]}, {ids[3 + k % 4] if k % 4 < 3 else "LEAD-FY2021-00000000"}].' for k, q in enumerate(said))
    docs = spark.createDataFrame([(1, body, "x", "x", None), (2, None, "x", "x", None)], DOCS_KIND)
    index = spark.createDataFrame([(i, "high", True, t, None, False) for i, t in zip(ids, texts, strict=True)] * 2, INDEX_KIND)
    got = {(r.par, r.said): (r.status, r.source_id) for r in checks.quote_report(docs, index).collect()}
    want = {}
    for k, q in enumerate(said):
        if len(q.strip()) >= 4:
            own = [t for i, t in zip(ids, texts, strict=True) if t and i in (ids[k % 3], ids[3 + k % 4] if k % 4 < 3 else "")]
            want[k, q] = plain_status(q, own, [t for t in texts if t])
    assert {key: status for key, (status, _) in got.items()} == want and {"ok", "elsewhere", "bad"} == set(want.values())
    assert all((source is not None) == (status == "elsewhere") or key[1] == "... [x] ..." for key, (status, source) in got.items())


def test_reports_write_what_they_read_of_paragraphs(spark, monkeypatch):
    index = spark.createDataFrame(INDEX, INDEX_KIND)
    docs = spark.createDataFrame([(1, DOC, "x", "x", None)], DOCS_KIND)
    written = []
    keep = checks.Stages.keep
    monkeypatch.setattr(checks.Stages, "keep", lambda self, df: written.append(set(df.columns)) or keep(self, df))
    assert checks.quote_report(docs, index).count() == 1
    assert written[:2] == [{"doc", "par", "ids", "said"}, {"doc", "par", "ids", "said", "texts"}]
    written.clear()
    checks.violations(docs, index, ["# Brief"], (10, 100), "Regulation FD")
    assert "flagged" in written[0] and not written[0] & {"answers", "registered", "segment_counts"}


def test_paragraphs_equal_their_patterns(spark):
    """The patterns by themselves, in Python, on paragraphs of pieces that nearly fit."""
    rng = random.Random(8)
    pieces = ["EVT-FY2021-aaaaaaaa", "evt-FY2021-aaaaaaaa", "XX-FY2021-00000000", "SP-FY2021-0123456789abcdef", "x", "[", "]. ", " ", "; ", "Low-Confidence", "low", "UNVERIFIED", "Indicative", "not established", "VOTE-FY2020-aaaaaaaa", "voted 2021", "On 3 May 2021", "Question", "REG FD", "2019: 11, 2020: 12, 2021: 13", "Item 402", "RULE 144", "Section 302", "form 10-K", "8-K", "DEF 14A", "SC 13G", "1,234.50", "777", "3.0", "$888", " \u0663\u0664\u0665 ", "five Segments", " İ ", " K ", '"', '"so it said"']
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(400)]
    texts = [t for t in texts if t.strip()]
    docs = spark.createDataFrame([(k, t, "x", "x", None) for k, t in enumerate(texts)], DOCS_KIND).withColumn("register", F.lit("(?i)reg fd"))
    got = {r.doc: r for r in checks.examined(docs, spark.createDataFrame(INDEX, INDEX_KIND)).collect()}
    known = rf"\b(?:{'|'.join(checks.CODES)})-FY\d{{4}}-[0-9a-f]{{8}}(?:[0-9a-f]{{8}})?\b"
    find = lambda pattern, t: re.search(pattern, t, re.ASCII) is not None
    normal = lambda n: n.replace(",", "").removesuffix(".0")
    for k, t in enumerate(texts):
        r, parts = got[k], [s.strip(" ") for s in re.split(r"(?<=[.;:])\s+", t, flags=re.ASCII)]
        ids = list(dict.fromkeys(re.findall(known, t, re.ASCII)))
        assert r.ids == ids and r.malformed == [i for i in dict.fromkeys(re.findall(checks.ANY_ID, t, re.ASCII)) if i not in ids], t
        assert (r.flagged, r.series, r.registered) == (find(checks.FLAGS, t), find(checks.SUBJECT, t) and find(checks.SERIES, t), find("(?i)reg fd", t)), t
        assert r.undated == any("VOTE-FY" in s and not find(checks.DATED, s) for s in parts), t
        assert r.segment_counts == [s for s in parts if find(checks.SEGMENT_COUNT, s)], t
        assert r.said == [q for q in re.findall('"([^"]+)"', t) if len(q.strip(" ")) >= 4], t
        prose = re.sub(checks.NO_FIGURE, " ", re.sub(known, "", t, flags=re.ASCII), flags=re.ASCII)
        figures = [normal(n) for n in re.findall(r"(?<![\w.])(\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+\.\d+|\d{3,})(?!\w)", prose)]
        assert r.figures == ([n for n in dict.fromkeys(figures) if not find(r"^(?:19|20)\d\d$", n)] if ids else []), t


def test_reviews(spark):
    body = "In 2021 it had five segments and in 2023 two reportable segments [SEG-FY2021-aaaaaaaa].\n\nIt had 777 units [EVT-FY2021-eeeeeeee].\n\nHe answers [QA-FY2021-bbbbbbbb, QA-FY2021-bbbbbbbb, SP-FY2021-aaaaaaaa].\n\nUnder Regulation FD [QA-FY2021-bbbbbbbb]."
    docs, index = spark.createDataFrame([(1, body, "x", "x", None)], DOCS_KIND), spark.createDataFrame(INDEX, INDEX_KIND)
    got = checks.reviews(docs, index, "regulation fd", [2021], [2022, 2023]).collect()
    assert {(r.par, r.list) for r in got} == {(0, "segment counts"), (1, "thin figure"), (2, "mostly answers")}
    assert [tuple(r)[1:] for r in checks.tiers(checks.examined(docs.withColumn("register", F.lit("x")), index)).collect()] == [(1, "777", "thin")]


def test_citation_report_by_field(spark):
    body = "[SP-FY2021-aaaaaaaa, EVT-FY2021-dddddddd] [EVT-FY2021-dddddddd] [EVT-FY2021-99999999] [MDNA-FY2021-aaaaaaaa] [RISK-FY2021-00000000]"
    index = spark.createDataFrame([*INDEX, ("RISK-FY2021-00000000", "high", True, "q", None, False)], INDEX_KIND)
    got = {r.doc: r for r in checks.citation_report(spark.createDataFrame([(1, body), (2, None)], "doc int, body string"), index).collect()}
    assert tuple(got[1])[1:] == (5, 4, 1, 1, 1, 1, {"events": 1, "risk": 1, "strategic_priorities": 1})
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, {})


def test_disposition_without_items_and_of_gap_forms(spark):
    scope = {"8-K": {"include": ["5.02"], "date_only": ["2.02"], "triage": ["7.01"]}}
    cases = [("8-K", None, "out_of_scope"), ("8-K", [], "out_of_scope"), ("8-K", ["2.02", "7.01"], "date_only"), ("8-K", ["7.01"], "triage"), ("10-K/A", ["x"], "gap_signal"), ("10-K", ["x"], "out_of_scope"), ("NT 10-K/A", None, "gap_signal")]
    df = spark.createDataFrame(cases, "form string, items array<string>, want string")
    got = df.select("want", ledger.disposition(F.col("form"), F.col("items"), ["10-K/A", "NT 10-K"], scope, ["8-K"])["disposition"].alias("got"))
    assert all(r.got == r.want for r in got.collect())


def test_json_of_every_control_character(spark):
    values = [*(f"a{chr(k)}b" for k in range(0x20)), '\\"\\n', "é\x7f\u2028", ""]
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", ledger.json_text(F.col("v")).alias("j")).collect()
    assert all(r.j == json.dumps(r.v, ensure_ascii=False) for r in got) and len(got) == 35


def test_fact_id_is_that_of_python(spark):
    value = {"b": 'x "y"\n\t\\', "a": "é"}
    body = {"field": "events", "fiscal_year": 2022, "value": value, "form": None, "accession": "1", "section_key": "k", "quote": "q"}
    want = "EVT-FY2022-" + hashlib.sha256(json.dumps(body, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:8]
    df = spark.createDataFrame([(value,)], "v map<string,string>")
    got = df.select(ledger.fact_id(F.lit("EVT"), F.lit(2022), F.lit("events"), F.col("v"), F.lit(None).cast("string"), F.lit("1"), F.lit("k"), F.lit("q"))).first()[0]
    assert got == want


def test_corrections_given_twice_or_not_matching(spark):
    df = spark.createDataFrame([(1, "a", "n")], "id int, v string, expected string")
    with pytest.raises(ValueError):
        rel.apply_corrections(df, spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], "id int, expected string, new_value string"), "id", "v", "v")
    patched, audit = rel.apply_corrections(df, spark.createDataFrame([(1, "b", "x")], "id int, expected string, new_value string"), "id", "v", "v")
    assert [tuple(r) for r in patched.collect()] == [(1, "a", "n", False)]
    with pytest.raises(ValueError):
        rel.exactly_once(audit)


def test_one_key_pairs_in_linear_time(spark):
    df = spark.range(300_000).selectExpr("1 as k", "id", "case when id % 3 = 0 then 'p' else 'v' end as kind", "timestamp_micros(id) as at")
    got = rel.asof_forward(df, "k", "at", F.col("kind") == "p", F.col("kind") == "v", "id")
    assert got.where("right_id = left_id + 1").count() == 100_000


BOILERPLATE = {"starts": r"(?i)\bitem \d{1,2}\.\d{2}\b", "ends": r"\bSIGNATURES?\b", "caution": r"(?i)caution(?:ary)? statements? regarding forward-looking statements", "caution_end": r"(?i)we do not undertake|except as required by law", "head": r"^EX-\S+ ", "image": r"(?i)\S+\.(?:jpg|jpeg|png|gif)\b"}


def plain_boilerplate(text, is_body):
    t = re.sub(r"\s+", " ", text)
    if is_body:
        if m := re.search(BOILERPLATE["starts"], t):
            t = t[m.start() :]
        if m := re.search(BOILERPLATE["ends"], t):
            t = t[: m.start()]
        if (m := re.search(BOILERPLATE["caution"], t)) and (n := re.compile(BOILERPLATE["caution_end"]).search(t, m.end())):
            t = t[: m.start()] + ledger.OMITTED + t[n.start() :]
    else:
        t = re.sub(BOILERPLATE["image"], "", re.sub(BOILERPLATE["head"], "", t))
    return re.sub(r"\s+", " ", t).strip()


def test_boilerplate_and_partial_dates(spark):
    pieces = ["Cover\npage ", "Item 5.02 ", "Departure. ", "CAUTIONARY STATEMENTS regarding forward-looking statements ", "we may be wrong, ", "we do not undertake ", "except as required by law ", "SIGNATURES ", "signed", "EX-99 ", "photo.jpg ", "\u00a0\t"]
    rng = random.Random(2)
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(150)]
    df = spark.createDataFrame([(t, k % 2 == 0) for k, t in enumerate(texts)] + [(None, True)], "t string, body boolean")
    got = df.select("t", "body", ledger.without_boilerplate(F.col("t"), F.col("body"), BOILERPLATE).alias("b"), ledger.cleaned(F.lit("\x93a\x94\u00a0 b\n")).alias("c")).collect()
    assert all(r.b == (None if r.t is None else plain_boilerplate(r.t, r.body)) for r in got) and got[0].c == "“a” b"
    dates = spark.createDataFrame([("2023-02-06",), ("2022-07",), ("2022",), ("July 2022",), ("2022-7",), ("",), (None,)], "d string").select(ledger.partial_date(F.col("d")).alias("p")).select("p.*").collect()
    assert [(r.date, r.precision) for r in dates] == [("2023-02-06", "day"), ("2022-07", "month"), ("2022", "year")] + [(None, None)] * 4


def test_an_id_of_two_ledgers_is_each_ones_own(spark):
    one = "EVT-FY2021-aaaaaaaa"
    docs = spark.createDataFrame([(d, d, f'It says "{q}" [{one}].', "x", "x", None) for d, q in ((1, "first words"), (2, "other words"), (3, "first words"))], "doc int, scope int, body string, stamped string, current string, gap_years array<int>")
    index = spark.createDataFrame([(1, one, "high", True, "first words", None), (2, one, "low", False, "other words", None)], "scope int, id string, confidence string, quote_verified boolean, quote string, claim string")
    assert {r.doc: (r.n_unknown, r.n_low, r.n_unverified) for r in checks.citation_report(docs, index).collect()} == {1: (0, 0, 0), 2: (0, 1, 1), 3: (1, 0, 0)}
    assert {r.doc: r.status for r in checks.quote_report(docs, index).collect()} == {1: "ok", 2: "ok", 3: "elsewhere"}
    broken = {(r.doc, r.rule) for r in checks.violations(docs, index, [], (0, 100), "x").collect()}
    assert broken == {(2, "no_unverified_quoted"), (2, "low_conf_flagged"), (3, "ids_resolve"), (3, "quotes_verbatim")}


def test_greedy_equals_a_loop_on_repeated_texts():
    rng = random.Random(5)
    words = ["hot bolt", "hot ring", "bolt hot", "small ring", "cold nut", "hot bolts", "colt"]
    for _ in range(60):
        left, right = ([(k, rng.choice(words)) for k in rng.sample(range(40), rng.randint(0, 14))] for _ in range(2))
        want, rows, columns = [], set(), set()
        for s, i, j in sorted(((tx.token_sort(a, b), i, j) for i, a in left for j, b in right), reverse=True):
            if s >= 40 and i not in rows and j not in columns:
                rows.add(i), columns.add(j), want.append((i, j, s))
        assert matching.greedy(left, right, 40) == want


def test_greedy_of_very_many_equal_texts():
    rows = [(k, ("hot bolt", "small ring", "cold nut")[k % 3]) for k in range(30_000)]
    start = time.monotonic()
    assert len(matching.greedy(rows[::2], rows[1::2], 60.0)) == 15_000
    assert time.monotonic() - start < 10


def test_fuzzy_pairs_link_what_all_pairs_link(spark, tmp_path):
    rng = random.Random(6)
    names = ["hot bolt", "bolt hot", "hot ring", "small ring", "nut", "", None]
    rows = [(k, rng.choice(["b1", "b2", None]), rng.choice([1, 2]), rng.choice(names)) for k in range(150)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_size int, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    got = {(r.a, r.b): r.score for r in catalogue.QUERIES["fuzzy_pairs"](spark, str(tmp_path)).collect()}
    tokens = lambda t: " ".join(sorted(set(t.split())))
    first, want = {}, {}
    for k, brand, size, name in rows:
        if brand and name:
            rep = first.setdefault((brand, size, tokens(name)), k)
            if rep != k:
                want[rep, k] = 100.0
    for (*block, p), a in first.items():
        for (*other, q), b in first.items():
            if a < b and block == other and (s := tx.token_set(p, q)) >= 55:
                want[a, b] = round(s, 4)
    assert got == want and len(got) < 150 * 2
