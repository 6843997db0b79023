"""Components, similarity joins and the timeline against plain Python over all pairs."""

import random
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.text import canonical, token_set
from ledgerline.operators import graph, similar, timeline
from ledgerline.sources.stages import Stages


def plain_components(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            if (x := todo.pop()) not in out:
                out[x] = start
                todo += near[x]
    return out


SHAPES = {
    "chain": [(k, k + 1) for k in range(60)],
    "backwards": [(k + 1, k) for k in reversed(range(40))],
    "star": [(7, k) for k in range(50)] + [(70, 71)],
    "random": [(random.Random(k).randrange(120), random.Random(k + 999).randrange(120)) for k in range(90)],
    "repeated": [(3, 1), (3, 1), (1, 3), (2, 2), (5, None), (None, 4)],
    "none": [],
}


@pytest.mark.parametrize("most", [100_000, 45, 0])
def test_components(spark, most):
    rows = [(name if name != "star" else None, a, b) for name, edges in SHAPES.items() for a, b in edges]
    df = spark.createDataFrame(rows, "block string, a int, b int").withColumn("root", F.lit("clash")).withColumn("node", F.lit(0))
    want = {(name if name != "star" else None, x): r for name, edges in SHAPES.items() for x, r in plain_components([e for e in edges if None not in e]).items()}
    got = graph.components_in_blocks(df, most).collect()
    assert {(r.block, r.node): r.root for r in got} == want and len(got) == len(want)


def test_components_of_a_table(spark):
    edges = [e for name in ("chain", "random") for e in SHAPES[name]]
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.root for r in got.collect()} == plain_components(edges) and got.columns == ["node", "root"]


def test_stages_are_dropped(spark):
    stages = Stages(spark)
    stages.keep(spark.range(3))
    assert stages.keep(spark.range(5)).count() == 5
    stages.drop(1)
    assert [p.name for p in Path(stages.folder.removeprefix("file:")).iterdir()] == ["2"]


WORDS = "the company board approved a dividend of 36 37 cents per share in 2021 2022 loan facility amended restated agreement director appointed resigned chief officer impairment loss recorded investment – “A” é shares shared".split()


def reports(seed, n, undated=0.3):
    rng = random.Random(seed)
    templates = [" ".join(rng.choices(WORDS, k=rng.randint(1, 14))) for _ in range(n // 8)]
    out = []
    for k in range(n):
        words = rng.choice(templates).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(words))
            words[at] = rng.choice([words[at] + "s", rng.choice(WORDS), words[at][:-1] or "x"])
        text = " ".join(words) + rng.choice(["", ".", "  "])
        date = None if rng.random() < undated else rng.choice(["2021", "2021-03", "2021-03-04", "2022-01-01"])
        out.append((k, date, rng.choice([text, text.upper(), text.replace(" ", "")]), rng.choice([None, [], ["f1"], ["f2"], ["f3", "f1"], ["f4", None]])))
    return [*out, (n, "2021", None, ["f9"]), (n + 1, None, "", None), (None, "2021", "no id", None)]


def all_pairs(rows, floor, dated):
    out = {}
    for x, y in combinations([r for r in rows if r[0] is not None and r[2] is not None and (r[1] is not None) == dated], 2):
        if (not dated or x[1] == y[1]) and not {*(x[3] or [])} - {None} & {*(y[3] or [])} and (s := token_set(canonical(x[2]), canonical(y[2]))) >= floor:
            out[x[0], y[0]] = s
    return out


SCHEMA = "id bigint, block string, text string, sources array<string>"


def expanded(pairs, reps, rows):
    """All pairs of rows that pairs of representatives stand for."""
    members, bare = {}, {r[0] for r in rows if r[0] is not None and not {*(r[3] or [])} - {None}}
    for r in reps.collect():
        members.setdefault(r.rep, []).append(r.id)
    out = {}
    for r in pairs.collect():
        if r.b in bare and r.b not in members:  # a row without a source and its representative: all such rows are pairs
            continue
        out |= {tuple(sorted((x, y))): r.score for x in members[r.a] for y in members[r.b]}
    return out | {pair: 100.0 for ids in members.values() if set(ids) <= bare for pair in combinations(sorted(ids), 2)}


@pytest.mark.parametrize("floor,tile", [(45, 1000), (55, 37), (95, 60)])
def test_pairs_in_blocks_equal_all_pairs(spark, floor, tile):
    rows = reports(floor, 400)
    df = spark.createDataFrame(rows + rows[:20], SCHEMA)
    pairs = similar.in_blocks(df, floor, tile)
    assert expanded(pairs, similar.representatives(df), rows) == all_pairs(rows, floor, True)
    assert pairs.count() == pairs.select("a", "b").distinct().count() and pairs.where("a >= b").count() == 0


@pytest.mark.parametrize("floor", [90, 95, 100])
def test_pairs_across_equal_all_pairs(spark, floor):
    rows = reports(floor, 500, undated=1)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash"))
    pairs, want = similar.across(df, floor), all_pairs(rows, floor, False)
    assert expanded(pairs, similar.representatives(df.drop("block")), rows) == want and len(want) > 50
    with pytest.raises(ValueError):
        similar.across(df, 89)


def test_a_text_of_very_many_rows_gives_few_pairs(spark):
    rows = [(k, "2021", "dividend declared", [f"f{k % 3}"]) for k in range(5000)] + [(k, "2021", "dividend declared again", None) for k in range(5000, 5100)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert similar.in_blocks(df, 55).count() == 3 + 3 + 99
    reports_ = df.select(F.concat(F.lit("E"), "id").alias("id"), F.col("id").alias("position"), F.col("block").alias("stated"), F.col("text").alias("description"), F.col("sources")[0].alias("accession"))
    pairs = timeline.same_date_pairs(reports_)
    assert graph.components_in_blocks(pairs.where("merges").select(F.col("date").alias("block"), "a", "b")).select("root").distinct().count() == 1
    assert pairs.count() < 2 * len(rows)


def test_candidates_are_far_below_the_square(spark):
    items = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("id"), similar.token_text(F.substring("text", 1, 80)).alias("key"))
    texts = items.groupBy("key").agg(F.min("id").alias("id")).where("key <> ''")
    n = texts.count()
    assert similar.candidates(texts, 95).count() < n * n / 2 / 10


ROW = "id string, position int, field string, type string, stated string, description string, quote string, accession string, source string, confidence string, fiscal_year int"


def table(spark, *rows):
    base = {"id": None, "position": 0, "field": "events", "type": "other", "stated": "2022-05-06", "description": "", "quote": "q", "accession": None, "source": None, "confidence": "high", "fiscal_year": 2022}
    full = [tuple((base | {"id": f"E{k}", "position": k} | r).values()) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, ROW)


def test_three_reports_of_one_event_join_through_the_third(spark):
    whole = "Entered a new credit agreement for a term loan and a revolving facility, and ended the prior credit agreement"
    df = table(
        spark,
        {"description": "Entered a new credit agreement for a term loan and a revolving facility", "accession": "a", "source": "s1", "type": "financing"},
        {"description": "Ended the prior credit agreement", "accession": "a", "confidence": "low", "type": "termination", "fiscal_year": 2023},
        {"description": whole, "accession": "b", "source": "s2", "type": "financing"},
        {"description": "Ended the prior credit agreement", "accession": "c", "stated": "2022-05-07", "type": None},
        {"description": "Directors elected at the annual meeting", "stated": "2020", "accession": "d"},
        {"description": "Directors elected, and a new chief executive, at the annual meeting", "stated": "spring of 2022", "accession": "d"},
    )
    pairs = timeline.same_date_pairs(df)
    assert {(r.a, r.b) for r in pairs.where("merges").collect()} == {(0, 2), (1, 2)}
    events = timeline.merged(df, pairs, ["(?i)elected"], ["(?i)chief executive"])
    got = {tuple(r.ids): r for r in events.collect()}
    one = got["E0", "E1", "E2"]
    assert (one.description, one.type, one.types_disagree, one.confidence, one.corroborating, one.fiscal_years, one.date, one.precision) == (whole, "financing", ["financing", "termination"], "low", 2, [2022, 2023], "2022-05-06", "day")
    assert one.also_described_as == [df.collect()[0].description, "Ended the prior credit agreement"] and one.sources == ["s1", "s2"] and one.quotes == ["q"] * 3
    assert got["E3",].type is None and got["E3",].also_described_as is None
    assert [(got[k,].routine, got[k,].predates_window, got[k,].date) for k in ("E3", "E4", "E5")] == [(False, False, "2022-05-07"), (True, True, "2020"), (False, False, None)]
    rows = timeline.counts(df, events, spark.createDataFrame([], "x int")).first()
    assert tuple(rows) == (6, 4, 2, 3, 1, 1, 1, 1, 0)
    assert timeline.merged(df.limit(0), timeline.same_date_pairs(df.limit(0)), ["x"], ["y"]).count() == 0


def test_undated_reports_are_listed_only(spark):
    a, b = "Recorded a $12.4 million impairment loss related to investment in an advisory firm.", "$12.4 million impairment loss recorded in 2024 related to the investment in an advisory firm."
    df = table(spark, {"description": a, "stated": None, "accession": "x"}, {"description": b, "stated": "n/a", "accession": "y"}, {"description": b, "stated": "", "accession": "y"}, {"description": b, "accession": "z"})
    assert {(r.a, r.b) for r in timeline.undated_pairs(df).collect()} == {(i, j) for i, j in [(0, 1)] if token_set(canonical(a), canonical(b)) >= 95}
    assert timeline.same_date_pairs(df).count() == 0


def test_date_conflicts(spark):
    rows = [("L1", 1, "2023-01-10", "a1", "8-K", "will leave", "x | departed | cfo"), ("L2", 2, "2023-01-31", "a2", "8-K/A", "As previously reported on the Original Form 8-K", "x | departed | cfo"), ("L3", 3, "2023-02-01", "a3", "8-K", "q", "y | appointed | ceo"), ("L4", 4, "2023-03-01", "a4", "8-K/A", "no reference", "y | appointed | ceo"), ("L5", 5, "2023", "a5", "8-K", "q", "z | left | coo"), ("L6", 6, "soon", "a6", "8-K", "q", "z | left | coo")]
    df = spark.createDataFrame(rows, "id string, position int, stated string, accession string, form string, quote string, identity string")
    got = {r.identity: r for r in timeline.date_conflicts(df).collect()}
    assert set(got) == {"x | departed | cfo", "y | appointed | ceo"}
    assert (got["x | departed | cfo"].resolved_date, got["x | departed | cfo"].resolved_by) == ("2023-01-31", ["a2"])
    assert (got["y | appointed | ceo"].resolved, got["y | appointed | ceo"].resolved_date, got["y | appointed | ceo"].filings) == (False, None, ["a3", "a4"])


def test_leadership_sentence(spark):
    cases = [(("A B", "role_changed", "CFO", "family"), "A B role changed — CFO (stated reason: family)"), (("A B", "left", None, None), "A B left"), ((None, "left", "CFO", ""), "left CFO"), ((None, None, None, None), "")]
    df = spark.createDataFrame([(*a, w) for a, w in cases], "n string, c string, r string, s string, want string")
    assert [r.got == r.want for r in df.select(timeline.leadership_sentence(*map(F.col, "ncrs")).alias("got"), "want").collect()] == [True] * 4
    assert df.select(timeline.identity(*map(F.col, "ncr"))).first()[0] == "a b | role_changed | cfo"


def test_candidates_of_names_grow_like_the_names(spark):
    rng, parts = random.Random(4), ["an", "ber", "cor", "da", "el", "gu", "ham", "jo", "ley", "ma", "ni", "or", "ren", "son", "tan", "vi"]
    names = sorted({" ".join(sorted("".join(rng.choices(parts, k=3)) for _ in range(2))) for _ in range(8000)})
    rng.shuffle(names)
    count = lambda n: similar.candidates(spark.createDataFrame(list(enumerate(names[:n])), "id long, key string"), 95).count()
    assert count(8000) < 1_000


def rows_sent(plan, name):
    """Rows that nodes of this name got from Python, over a plan that has run."""
    if hasattr(plan, "plan") and "QueryStage" in plan.nodeName() or "AdaptiveSparkPlan" in plan.nodeName():
        return rows_sent(plan.executedPlan() if "Adaptive" in plan.nodeName() else plan.plan(), name)
    own = plan.metrics().get("pythonDataSent").get().value() if name in plan.nodeName() else 0
    return own + sum(rows_sent(plan.children().apply(i), name) for i in range(plan.children().size()))


def test_small_blocks_need_no_call_of_their_own(spark):
    rng = random.Random(8)
    sizes = [1, 2, 3, similar.FEW - 1, similar.FEW]
    rows = [(100 * b + k, b, " ".join(rng.choices(["port", "city", "bel", "corf", "ar"], k=3)), [f"s{rng.randrange(3)}"]) for b in range(40) for k in range(sizes[b % 5])]
    found = similar.in_blocks(spark.createDataFrame(rows, "id int, block int, text string, sources array<string>"), 55)
    got = {(r.a, r.b): r.score for r in found.collect()}
    assert rows_sent(found._jdf.queryExecution().executedPlan(), "FlatMapGroupsInArrow") == 0
    first = {}
    for i, b, text, s in rows:
        first.setdefault((b, " ".join(sorted(set(text.split()))), s[0]), i)
    want = {(i, j): score for ((b, x, s), i), ((c, y, t), j) in combinations(first.items(), 2) if b == c and s != t and (score := token_set(x, y)) >= 55}
    assert {tuple(sorted(p)): v for p, v in want.items()} == got and len(got) > 100


def test_many_small_blocks_of_edges(spark):
    edges = [(b, k, k + 1) for b in range(300) for k in range(b % 4)]
    got = {(r.block, r.node): r.root for r in graph.components_in_blocks(spark.createDataFrame(edges, "block int, a int, b int"), 50).collect()}
    assert got == {(b, n): 0 for b in range(300) for n in range(b % 4 + 1) if b % 4}
