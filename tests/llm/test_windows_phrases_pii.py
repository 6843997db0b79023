"""Rolling features, phrase mining and personal data against brute force, exhaustive sums and hand-made cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import phrases, pii, queries, rolling

TINY = "/root/testdata/sf0.001"


# rolling features


def brute_windows(rows, times, windows):
    """rows: (group, text, lang); the measures of each row and window, in the order of rows."""
    out = []
    for (group, _, _), t in zip(rows, times, strict=True):
        for w in windows:
            inside = [r for r, u in zip(rows, times, strict=True) if t is not None and u is not None and r[0] == group and t - w <= u < t]
            sizes = sorted(len(text) for _, text, _ in inside if text is not None)
            m = len(sizes)
            order = [sizes[math.ceil(m / 2) - 1], sizes[math.ceil(75 * m / 100) - 1]] if m else [None, None]
            out.append((w, t, len(inside), sum(sizes), len({lang for *_, lang in inside} - {None}), *order))
    return out


def test_wavelet_matrix_equals_sorting():
    rng = np.random.default_rng(5)
    for top in (1, 2, 7, 1000, 1 << 40):
        values, weights = rng.integers(0, top, 200), rng.integers(1, 5, 200)
        matrix = rolling.WaveletMatrix(values, weights)
        lo = rng.integers(0, 200, 300)
        hi = np.array([rng.integers(a + 1, 201) for a in lo])
        k = np.array([rng.integers(1, weights[a:b].sum() + 1) for a, b in zip(lo, hi, strict=True)])
        want = [np.sort(np.repeat(values[a:b], weights[a:b]))[c - 1] for a, b, c in zip(lo, hi, k, strict=True)]
        assert matrix.kth(lo, hi, k).tolist() == want
    assert rolling.WaveletMatrix(np.zeros(3, np.int64), np.ones(3, np.int64)).kth(np.array([0]), np.array([3]), np.array([2])).tolist() == [0]


@pytest.mark.parametrize("spread", [30, 3000])
def test_rolling_equals_brute_force(spark, spread):
    rng = random.Random(spread)
    rows = [(rng.choice(["hot", "hot", "b", None]), rng.choice([None, "", "é" * rng.randint(1, 9), "x" * rng.choice([3, 5000])]), rng.choice(["en", "fr", "de", None])) for _ in range(250)]
    times = [rng.choice([None, *[rng.randint(-spread, spread)] * 9]) for _ in rows]
    docs = spark.createDataFrame([(k, *r, t) for k, (r, t) in enumerate(zip(rows, times, strict=True))], "doc_id bigint, source string, text string, lang string, t bigint")
    got = rolling.rolling_features(docs, F.col("t"), windows=(7, 100)).orderBy("doc_id", "window_s").collect()
    assert [tuple(r)[1:] for r in got] == brute_windows(rows, times, (7, 100))
    assert [r.doc_id for r in got] == [k for k in range(250) for _ in range(2)]


def test_event_time(spark):
    ids = [0, 1, 7, 123456789, -5, -4000, 2**59, -(2**59), None]
    got = {r.doc_id: r.t for r in spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", rolling.event_time().alias("t")).collect()}
    assert got == {i: None if i is None else 60 * ((i + zlib.crc32(str(i).encode()) % 4000) // 6) for i in ids}
    assert [r[0] for r in spark.createDataFrame([("no number",), (str(2**62),)], "doc_id string").select(rolling.event_time()).collect()] == [None, None]


def test_rolling_query_and_edge_cases(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").orderBy("doc_id").collect()
    times = [60 * ((r.doc_id + zlib.crc32(str(r.doc_id).encode()) % 4000) // 6) for r in docs]
    got = queries.op11_rolling(spark, TINY).orderBy("doc_id", "window_s").collect()
    assert [tuple(r)[1:] for r in got] == brute_windows([(r.source, r.text, r.lang) for r in docs], times, (3600, 21600))
    odd = spark.createDataFrame([(None, "a", "s", "en", 1), (3, "b", "s", "en", 1), (3, "b", "s", "en", 1)], "doc_id bigint, text string, source string, lang string, grp int").withColumn("id", F.lit("clash")).withColumn("t", F.lit("clash")).withColumn("each", F.lit(0))
    rows = rolling.rolling_features(odd, rolling.event_time()).collect()
    assert len(rows) == 6 and all((r.n_events, r.sum_chars, r.n_langs, r.median_chars) == (0, 0, 0, None) for r in rows)
    assert sum(r.event_s is None for r in rows) == 2
    assert rolling.rolling_features(odd.limit(0), rolling.event_time()).count() == 0


# phrases


def brute_phrases(docs, least=30, cover=80, longest=4, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    lower = {i: i + 32 for i in range(65, 91)}
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dead = {q[i:j] for q in found for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and 100 * found[q] >= cover * found[q[i:j]]}
        rows = []
        for p, a in found.items():
            if p not in dead:
                value, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((value, a, " ".join(p), f[p[:k]], f[p[k:]]))
        rows.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, left, right, totals[lang], value) for i, (value, a, p, left, right) in enumerate(rows[:top])]
    return sorted(out)


def mined(spark, docs, **options):
    df = spark.createDataFrame(docs, "text string, lang string").withColumn("chunk", F.lit("clash")).withColumn("n", F.lit(0))
    return sorted(tuple(r) for r in phrases.mine_phrases(df, **options).collect())


@pytest.mark.parametrize("chunk", [40, 1 << 20])
def test_phrases_equal_brute_force(spark, chunk):
    rng = random.Random(chunk)
    words = ["a", "B", "c", "Ünder", "ü", "x-y", "x\x0by", "\t", "", "中"]
    docs = [("".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n", "!"] if rng.random() < 0.2 else [" "]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "fr", None])) for _ in range(120)]
    docs += [(None, "en"), ("", None), ("a b c d " * 3000, "en"), ("a b c d " * 3000, "en"), ("q" * 5000, "fr"), ("...", "de")]
    assert mined(spark, docs, least=3, chunk_words=chunk) == brute_phrases(docs, least=3)
    assert mined(spark, docs, least=2, top=5, cover=50, longest=3, chunk_words=chunk) == brute_phrases(docs, least=2, top=5, cover=50, longest=3)


def test_phrases_without_candidates(spark):
    assert mined(spark, [("a b c", "en"), (None, None)]) == [] == mined(spark, [("x", "en")])[:0]
    assert phrases.mine_phrases(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_products_beyond_64_bits(spark):
    big = 2**62
    row = spark.sql(f"select {big}L as a, {big - 1}L as l, {big - 3}L as r").select(phrases.score(F.col("a"), F.col("l"), F.col("r")).cast("string")).first()
    assert int(row[0]) == 2000000 * big // (2 * big - 4)


def test_queries_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{TINY}/documents.parquet'")
    for name in ("op11_rolling", "op12_phrases"):
        df, want = queries.QUERIES[name](spark, TINY), con.sql(queries.ORACLE_SQL[name])
        columns = sorted(df.columns)
        assert columns == sorted(want.columns)
        assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, want.select(*columns).fetchall()))


# personal data

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(d * 2 - 9 * (d > 4) if k % 2 else d for k, d in enumerate(reversed(digits))) % 10 == 0
            ok = {"email": True, "ip": kind == "ip" and max(map(int, m[0].split("."))) <= 255, "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}
            if ok[kind]:
                out.append((kind, *m.span()))
    return out


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_patterns_equal_regular_expressions():
    rng = random.Random(8)
    for size, letters in ((50, "ab1@.+- ()%_é"), (60, "0123456789. -"), (40, "+1 ()23-.45"), (30, "1.2")):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, size)))
            assert [(pii.KINDS[k], a, b) for k, a, b in pii.pattern_spans(text)] == brute_spans(text), text


@pytest.mark.parametrize("text", ["1" * 400_000, "a" * 400_000 + "@" + "b" * 400_000, "+1" + "(" * 400_000, "1." * 200_000, "a@" * 200_000, "x1" * 300_000])
def test_long_texts_take_linear_time(text):
    import time

    began = time.process_time()
    pii.Graph([text], [pii.pattern_spans(text)])
    assert time.process_time() - began < 10


def test_marginals_equal_sums_over_all_labellings():
    rng = np.random.default_rng(2)
    text = "call +1 (918) 555-3922 or 918.555.3922 x y2 918.555.3922"
    graph = pii.Graph([text], [pii.pattern_spans(text)])
    assert len(graph.nodes) == 6 and [len(e) for e in graph.edges] == [3, 1, 1]
    n = len(pii.KINDS) + 1
    skip = [w + w.T for w in rng.normal(size=(2, n, n))]
    field = pii.Field(rng.normal(size=(pii.N_FEATURES, n)), [rng.normal(size=(n, n)), *skip])
    own, total = graph.scores(field.unary), np.zeros((6, n))
    for labels in itertools.product(*[range(n) if k < 0 else [k] for k in graph.label]):
        score = sum(own[k, x] for k, x in enumerate(labels) if graph.label[k] < 0)
        score += sum(w[labels[i], labels[j]] for w, e in zip(field.edge, graph.edges, strict=True) for i, j in e)
        total[range(6), labels] += np.exp(score)
    assert np.allclose(pii.marginals(field, graph, rounds=300), total / total.sum(1, keepdims=True), atol=1e-3)


def test_fitted_field_finds_held_out_mentions(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(F.col("text").rlike("[0-9@]") & (F.length("text") < 20000)).orderBy("doc_id").select("text").collect()]
    field = pii.fit_texts(texts[::2])
    whole, known, truth = pii.practice(texts[1::2], seed=3)
    want = {(d, s) for d, spans in enumerate(truth) for s in set(spans) - set(known[d])}
    got = {(d, s) for d, spans in enumerate(pii.added_spans(field, whole, known)) for s in spans}
    assert len(want) > 200 and len(got & want) >= 0.9 * len(want) and len(got - want) <= 0.02 * len(got)
    plain = [pii.pattern_spans(t) for t in texts[1::2]]
    assert sum(map(len, pii.added_spans(field, texts[1::2], plain))) <= 0.01 * sum(map(len, plain))  # clean texts stay clean
    mail = "Write to reon.24@mail3.example.com today. Later, reon.24[at]mail3.example.com answers; other.17[at]host4.example.org does not."
    assert [(k, mail[a:b]) for k, a, b in pii.added_spans(field, [mail], [pii.pattern_spans(mail)])[0]] == [(pii.EMAIL, "reon.24[at]mail3.example.com")]


def test_pii_query_keeps_pattern_spans(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    rows = queries.op13_pii(spark, TINY).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = brute_spans(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in FORMS]
        assert set(written(spans).split(",")) - {""} <= set(r.spans.split(",")) and len(r.spans.split(",") if r.spans else []) == len(spans) + r.n_added


def test_pii_edge_cases(spark):
    schema = "doc_id bigint, text string, spans string, id string"
    docs = spark.createDataFrame([(1, None, "x", "y"), (2, "", "x", "y"), (3, "a.b@c.de " * 2000, "x", "y"), (3, "a.b@c.de " * 2000, "x", "y"), (None, "+1 918 555 3922", "x", "y")], schema)
    got = sorted(pii.find_pii(docs, pii.learn(docs)).collect(), key=lambda r: (r.doc_id or 0, r.n_email))
    assert [(r.doc_id, r.n_email, r.n_phone) for r in got] == [(None, 0, 1), (1, 0, 0), (2, 0, 0), (3, 2000, 0), (3, 2000, 0)]
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.learn(docs.limit(0)) is None and pii.find_pii(docs.limit(0), None).count() == 0
