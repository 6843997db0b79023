"""Signals, decisions and the catalogue of filings against a loop over regular expressions."""

import json
import random
import re

from pyspark.sql import functions as F

from ledgerline.operators import triage
from ledgerline.sources import shards

PATTERNS = {"deal": [r"\bmerger\b", r"acqui\w+"], "qa": [r"question \d+"], "dividend": [r"dividend", r"per share"]}
KINDS = {"material": ["deal"], "narrative": ["qa"], "routine": ["dividend"]}


def plain_signals(text, headline):
    out = {}
    for name, patterns in PATTERNS.items():
        hits = sorted((m.start(), m[0][:80], p) for p in patterns if (m := re.search(p, text or "", re.I)))
        if hits:
            out[name] = ("strong" if hits[0][0] < headline else "mention", hits[0][0], len(hits), hits[:3])
    return out


def plain_decision(docs, headline):
    found = [plain_signals(t, headline) for t in docs]
    strong, seen = {s for d in found for s, v in d.items() if v[0] == "strong"}, {s for d in found for s in d}
    if not docs:
        return "read", ["events"]
    routes = ["events"] * ("deal" in strong) + ["investor_qa"] * ("qa" in seen)
    if routes:
        return "read", routes
    return ("date_only", []) if "dividend" in strong and "deal" not in seen else ("read", ["events"])


def some_texts(n):
    rng = random.Random(7)
    words = ["Merger", "acquired", "question 5", "DIVIDEND", "per share", "other", "words", "é", "\n"]
    return [(k // 2, None if k % 17 == 0 else " ".join(rng.choices(words[3:] if k % 3 else words, k=rng.randint(0, 12)))) for k in range(n)]


def test_signals_equal_a_loop(spark):
    docs = some_texts(120)
    df = spark.createDataFrame(docs, "accession int, text string").select("text", triage.signals(F.col("text"), PATTERNS, 20).alias("s"))
    for r in df.collect():
        assert {s.signal: (s.strength, s.first_at, s.n_patterns, [tuple(e) for e in s.evidence]) for s in r.s} == plain_signals(r.text, 20)


def test_decisions_equal_a_loop(spark):
    docs = some_texts(160)
    filings = spark.createDataFrame([(k, 2020 + k % 3) for k in range(85)], "accession int, fiscal_year int")
    out = triage.triage(filings, spark.createDataFrame(docs, "accession int, text string"), PATTERNS, 20, KINDS)
    rows = out.collect()
    want = {k: plain_decision([t for a, t in docs if a == k], 20) for k in range(85)}
    assert {r.accession: (r.decision, r.routes) for r in rows} == want and {d for d, _ in want.values()} == {"read", "date_only"}
    assert {r.reason for r in rows if r.accession >= 80} == {"no text to judge by"}
    assert sum(r.n for r in triage.triage_counts(out).collect()) == 85
    tally = {(r.signal, r.strength): r.n for r in triage.signal_counts(spark.createDataFrame(docs, "a int, text string"), PATTERNS, 20).collect()}
    every = [(s, v[0]) for _, t in docs for s, v in plain_signals(t, 20).items()]
    assert tally == {k: every.count(k) for k in set(every)}


def test_catalogue_of_a_cached_index(spark, tmp_path):
    rows = {"accessionNumber": ["1", "2", "3", "4"], "form": ["8-K", "10-K", "NT 10-K", "8-K"], "filingDate": ["2022-05-01", "2022-02-20", "2021-04-01", "2030-01-01"], "reportDate": ["", "2021-12-31", "", ""], "items": ["5.02, 9.01", "", "", ""]}
    (tmp_path / "co.json").write_text(json.dumps({"filings": {"recent": rows}}))
    scope = {"8-K": {"include": ["5.02"], "date_only": [], "triage": []}, "10-K": {}}
    got = {r.accession: r for r in triage.catalogued(shards.read_filings(spark, str(tmp_path), "co", "2000-01-01"), (12, 31), (2021, 2023), ["NT 10-K"], scope, ["8-K"]).collect()}
    assert {k: (r.fiscal_year, r.disposition, r.in_window) for k, r in got.items()} == {"1": (2022, "in_scope", True), "2": (2021, "in_scope", True), "3": (2021, "gap_signal", True), "4": (2030, "out_of_scope", False)}
    assert got["1"].items == ["5.02", "9.01"] and got["2"].items == []


def test_first_of_each_and_union(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None), (None, 1, "z")], "k string, o int, v string")
    assert sorted(map(tuple, triage.first_of_each(df, ["k"], ["o"]).collect()), key=str) == sorted([("a", 1, "y"), ("b", 3, None), (None, 1, "z")], key=str)
    assert triage.union_all([df, df.select("v", "o", "k")]).count() == 8
