"""Values, edits, letters and the ledger build against Python's own JSON, string methods and hand-made cases."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import values
from ledgerline.operators import build, edits, letters


def digest(body):
    return hashlib.sha256(json.dumps(body, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:8]


def some_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    if kind < 5:
        return [None, True, rng.choice([0, -7, 10**20, 1.5, 1e300, 0.1]), "".join(rng.choice("aé\"\\\n\x01 😀") for _ in range(rng.randint(0, 6))), ""][kind]
    if kind < 6:
        return [some_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {"".join(rng.choice("bBa_é1") for _ in range(rng.randint(1, 3))): some_value(rng, depth + 1) for _ in range(rng.randint(0, 4))}


def test_ids_are_those_of_python(spark):
    rng = random.Random(3)
    objects = [{"a": some_value(rng), "Z": some_value(rng), "id": 1, "changed": [1]} for _ in range(120)]
    df = spark.createDataFrame([(k, json.dumps(o), f"q{k}\x02" if k % 3 else None) for k, o in enumerate(objects)], "k int, v string, q string")
    lit = F.lit
    got = df.select("k", values.canonical_value("v").alias("c"), values.value_id(lit("EVT"), lit("events"), lit(2022), values.canonical_value("v"), lit("8-K"), F.col("q"), lit(None).cast("string"), F.col("q")).alias("id"), values.risk_delta_id(lit(2024), lit("added"), F.col("v"), lit("a"), lit(None).cast("string")).alias("risk")).collect()
    for r in got:
        o, q = objects[r.k], f"q{r.k}\x02" if r.k % 3 else None
        assert r.c == json.dumps(o, sort_keys=True, ensure_ascii=False)
        assert r.id == "EVT-FY2022-" + digest({"field": "events", "fiscal_year": 2022, "value": o, "form": "8-K", "accession": q, "section_key": None, "quote": q})
        assert r.risk == "RISK-FY2024-" + digest({"kind": "risk_delta", "fiscal_year": 2024, "delta_category": "added", "item": {k: v for k, v in o.items() if k not in ("id", "changed")}, "accession": "a", "prior_accession": None})


def plain_leaves(v, path="$"):
    if isinstance(v, dict):
        return [x for k, w in v.items() for x in plain_leaves(w, f"{path}.{k}")]
    if isinstance(v, list):
        return [x for k, w in enumerate(v) for x in plain_leaves(w, f"{path}[{k}]")]
    return [path]


def test_leaves_at_any_depth(spark, monkeypatch):
    deep = {"x": 1}
    for _ in range(4):
        deep = {"d": [deep, "t"]}
    objects = [deep, [], {}, {"a": {"b": [1, {"c": "é"}]}, "n": None}, 5, "s"]
    df = spark.createDataFrame([*((k, json.dumps(o)) for k, o in enumerate(objects)), (90, "{broken"), (91, None)], "k int, v string")
    got = values.leaves(df, "k", "v").collect()
    assert sorted((r.id, r.path) for r in got) == sorted((k, p) for k, o in enumerate(objects) for p in plain_leaves(o))
    monkeypatch.setattr(values, "MOST_LEVELS", 5)
    with pytest.raises(ValueError, match="5 levels"):
        values.leaves(df, "k", "v")
    assert {r.path: r.leaf for r in got if r.id == 3} == {"$.a.b[0]": "1", "$.a.b[1].c": "é", "$.n": None}


def test_corrections_are_a_fold(spark):
    docs = spark.createDataFrame([("a", "one two one three"), ("b", "untouched"), ("c", None)], "doc string, text string")
    rows = [("a", 2, "E2", "two uno", "2 1"), ("a", 1, "E1", "two one", "two uno"), ("a", 3, "E3", "one", "once"), ("a", 4, "E4", "four", "4"), ("a", 5, "E5", "", "x"), ("a", 6, "E6", "e", "E"), ("c", 1, "E7", "x", "y"), ("gone", 1, "E8", "x", "y")]
    fixes = spark.createDataFrame(rows, "doc string, seq int, id string, find string, replace string")
    got = {r.doc: r for r in edits.corrected(docs, fixes).collect()}
    assert got["a"].text == "once 2 1 three" and [r.id for r in got["a"].records] == ["E1", "E2", "E3"]
    assert [tuple(p) for p in got["a"].problems] == [("E4", 0), ("E5", 0), ("E6", 3)]
    assert (got["b"].text, got["b"].problems, got["c"].text) == ("untouched", [], None)
    assert [tuple(p) for d in ("c", "gone") for p in got[d].problems] == [("E7", 0), ("E8", 0)]
    none = spark.createDataFrame([], "was string, now string, problem string")
    with pytest.raises(ValueError, match="E4 found 0 times"):
        edits.usable(edits.corrected(docs, fixes), none)
    edits.usable(edits.corrected(docs, fixes.where("seq < 4 and doc = 'a'")), none)


def test_overlapping_occurrences_count_like_python(spark):
    cases = [("aaaa", "aa"), ("abab", "ab"), ("", "a"), ("a.c abc", "a.c"), ("ééé", "é")]
    got = spark.createDataFrame(cases, "t string, f string").select("t", "f", edits.times(F.col("t"), F.col("f")).alias("n")).collect()
    assert all(r.n == r.t.count(r.f) for r in got)


def test_remaps(spark):
    ids = [f"EVT-FY2021-{k:08x}" for k in range(8)]
    docs = spark.createDataFrame([(1, f"x [{ids[0]}] y [{ids[0]}, {ids[2]}]"), (2, "none"), (3, None)], "doc int, text string")
    remaps = spark.createDataFrame([(ids[0], ids[1]), (ids[2], ids[3])], "was string, now string")
    index = spark.createDataFrame([(ids[1],), (ids[3],), (ids[4],)], "id string")
    claims = spark.createDataFrame([(ids[0], "A"), (ids[1], "A"), (ids[3], "B"), (ids[5], "C"), (ids[4], "D")], "id string, claim string")
    assert edits.remap_problems(remaps, index, claims).count() == 0
    wrong = spark.createDataFrame([(ids[4], ids[1]), (ids[2], ids[6]), (ids[5], ids[4])], "was string, now string")
    problems = {r.was: r.problem for r in edits.remap_problems(wrong, index, claims).collect()}
    assert problems == {ids[4]: "the old id is still there", ids[2]: "the new id is not there", ids[5]: "they say different things"}
    got = {r.doc: r for r in edits.remapped(docs, remaps).collect()}
    assert got[1].text == f"x [{ids[1]}] y [{ids[1]}, {ids[3]}]" and [tuple(r) for r in got[1].remaps] == [(ids[0], ids[1], 2), (ids[2], ids[3], 1)]
    assert got[2].text == "none" and got[3].text is None


STARTS, ENDS, SIGNED = [r"dear (?:fellow )?shareholders", r"to our shareholders"], [r"sincerely,?", r"best regards"], [r"Chief Executive Officer"]


@pytest.mark.parametrize(
    "text,want",
    [
        (None, (None, None, "no text")),
        ("Nothing here", (None, None, "no salutation")),
        ("Cover. Dear shareholders, good year. SINCERELY, Ann Lee" + " then the report" * 20, ("Dear shareholders, good year. SINCERELY, Ann Lee t", "sign-off", None)),
        ("Sincerely, early. To our shareholders and dear shareholders. Best regards, B", ("To our shareholders and dear shareholders. Best regards, B", "sign-off", None)),
        ("Dear shareholders " + "w " * 40 + "Chief Executive Officer\fBalance", ("Dear shareholders " + "w " * 40 + "Chief Executive Officer", "signature", None)),
        ("Dear shareholders Chief Executive Officer x " + "w " * 40 + "Chief Executive Officer and more text after it", ("Dear shareholders Chief Executive Officer x " + "w " * 40 + "Chief Executive Officer and more", "signature", None)),
        ("Dear shareholders Chief Executive Officer", (None, None, "no sign-off and no signature that fits")),
    ],
)
def test_letter_bounds(spark, text, want):
    found = letters.letter_of(F.col("t"), STARTS, ENDS, SIGNED, 10, 60, 400)
    r = spark.createDataFrame([(text,)], "t string").select(found.alias("l")).first().l
    assert (r.letter, r.rule, r.error) == want


RAW = "fact string, field string, fiscal_year int, value string, quote string"
SOURCES = "source_id string, form string, accession string, section_key string, filing_date string, text string"
FIXES = "id string, seq int, field string, fiscal_year int, accession string, match string, set string"
TABLE = "The matters voted on at the annual meeting are as follows. Ann Lee\n28,789,451\n9,935,476\n15,365\nBob Ray\n28,789,451\n9,935,476\n15,365\nThe board approved a new dividend policy in March."


def ledger_of(spark, fixes=(), quote="The board approved a new dividend policy", twice=False):
    vote = {"matter": "Election of director Bob Ray", "votes_for": 28789451, "withheld": 15365, "votes_against": 9935476, "note": None}
    raw = [("f1", "events", 2022, json.dumps({"type": "dividend", "n": [1, {"b": 2, "a": 1}]}), quote), ("f2", "vote_results", 2022, json.dumps(vote), "The matters voted on at the annual meeting are as follows"), ("f3", "odd_field", 2022, None, "never said anywhere in any of the filings"), ("f4", "board", 2023, "{}", None)]
    if twice:
        raw.append(("f5", *raw[0][1:]))
    sources = [("s1", "8-K", "a1", "body", "2022-05-01", TABLE), ("s2", "10-K", "a2", "weak", "2022-06-01", None)]
    listing = [(f[0], p, s) for f in raw[:3] + raw[4:] for p, s in ((1, "s1"), (0, "s2"))]
    return build.build(spark.createDataFrame(raw, RAW), spark.createDataFrame(listing, "fact string, place int, source_id string"), spark.createDataFrame(sources, SOURCES), spark.createDataFrame(list(fixes), FIXES), ["weak"])


FIX = ("C1", 1, "events", 2022, "a1", '{"type": "dividend"}', '{"type": "policy", "amount": 3}')


def test_build(spark):
    got = {r.fact: r for r in ledger_of(spark, [FIX, ("C2", 2, "events", 2030, "a1", "{}", "{}")]).collect()}
    assert (got["f1"].source_id, got["f1"].verified, got["f1"].confidence, got["f1"].correction, json.loads(got["f1"].was)) == ("s1", True, "high", "C1", {"type": "dividend", "amount": None})
    value = {"type": "policy", "amount": 3, "n": [1, {"b": 2, "a": 1}]}
    assert got["f1"].id == "EVT-FY2022-" + digest({"field": "events", "fiscal_year": 2022, "value": value, "form": "8-K", "accession": "a1", "section_key": "body", "quote": got["f1"].quote})
    assert got["f2"].quote == "Bob Ray\n28,789,451\n9,935,476\n15,365" and got["f2"].why.endswith(build.REANCHORED)
    assert (got["f3"].id[:11], got["f3"].verified, got["f3"].confidence, got["f3"].form, got["f3"].value) == ("ODD_-FY2022", False, "low", None, "{}")
    assert "s2: source text unavailable" in got["f3"].why and got["f4"].why == "no sources to check against"


@pytest.mark.parametrize(
    "options,message",
    [
        ({"fixes": [FIX, ("C9", 2, "events", 2022, "a1", '{"type": "gone"}', "{}")]}, "C9 met 0"),
        ({"fixes": [FIX], "twice": True}, "C1 met 2"),
        ({"twice": True}, "of 2 facts"),
        ({"fixes": [FIX, FIX]}, "share an id"),
    ],
)
def test_a_broken_gate_hands_nothing_on(spark, options, message):
    with pytest.raises(ValueError, match=message):
        ledger_of(spark, **options)


def test_spelled_out_characters_never_reach_a_quotation(spark):
    assert {r.fact: r.quote for r in ledger_of(spark, quote="The board approved a new \\u0064ividend policy").collect()}["f1"] == "The board approved a new dividend policy"
    with pytest.raises(ValueError, match="spelled-out"):
        ledger_of(spark, quote="Nobody ever said \\u2019this\\u2019 in a filing")


def test_ids_that_agree_by_chance_are_told_apart(spark):
    raw = [(str(n), "odd", 2022, json.dumps({"n": n}), "x") for n in (24206, 73640, 7)]  # the first two agree in 8 digits
    empty = lambda kind: spark.createDataFrame([], kind)
    rows = build.build(spark.createDataFrame(raw, RAW), empty("fact string, place int, source_id string"), empty(SOURCES), empty(FIXES), []).collect()
    got = {r.fact: r.id for r in rows}
    body = lambda n: {"field": "odd", "fiscal_year": 2022, "value": {"n": n}, "form": None, "accession": None, "section_key": None, "quote": "x"}
    whole = {str(n): hashlib.sha256(json.dumps(body(n), sort_keys=True).encode()).hexdigest() for n in (24206, 73640, 7)}
    assert whole["24206"][:8] == whole["73640"][:8]
    assert got == {k: f"ODD-FY2022-{h[: 8 if k == '7' else 16]}" for k, h in whole.items()}
