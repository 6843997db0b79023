"""Attribution of quotations against brute force; the canonical form of quotations over all scripts."""

import random
import time
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import quotes
from ledgerline.functions.text import FOLD, IMAGE_NAME, SHORTEST, TAIL, canonical, decoded
from ledgerline.operators import attribution


def judged(quote, text):
    """The rule by itself: each beginning of the quotation is tried."""
    if text is None:
        return False, attribution.UNAVAILABLE
    q, hay = canonical(quote or ""), canonical(text)
    if len(q) < SHORTEST:
        return False, "too short"
    n = max((k for k in range(len(q) + 1) if q[:k] in hay), default=0)
    if n == len(q):
        return True, "verbatim"
    if n >= SHORTEST and len(q) - n <= TAIL:
        return True, "stray tail"
    return False, "diverges" if n >= 0.25 * len(q) else "not found"


def altered(rng, text):
    n = rng.choice([1, 10, 24, 25, 26, 28, 60, 200])
    at = rng.randrange(max(1, len(text) - n))
    quote = text[at : at + n]
    return rng.choice([quote, quote.upper(), quote + "zq", quote + "zqxj", quote[: n // 2] + "Z" * (n // 2), quote[: n // 5] + "Y" * n, quote.replace(" ", "  \n"), "’".join(quote.split("'")), "none of it"])


@pytest.mark.parametrize("block", [40, 1_000_000])
def test_attribution_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(attribution, "BLOCK_CHARS", block)  # read on the driver
    rng = random.Random(4)
    words = ["the", "board", "it's", "é", "margin", "rose", "12%", "—", "“so”", "image.jpg", "aa", "aaa"]
    sources = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 80, 300])))) for k in range(25)] + [(25, None), (0, "a second row of source 0 with other words entirely"), (None, "no id")]
    facts = [(k, altered(rng, rng.choice(sources[:25])[1] or "x")) for k in range(150)] + [(150, None), (151, ""), (152, "a second row of source 0 with other words")]
    hot = [(k, 1, 3) for k, _ in facts]  # one source that all list
    listing = [(k, p, rng.choice([*range(27), 99])) for k, _ in facts[:149] for p in rng.sample(range(2, 9), rng.randint(0, 3))] + hot + [(152, 9, 0), (152, 0, 99)]
    listing += listing[:40]
    got = attribution.attribute(spark.createDataFrame(facts, "fact_id bigint, quote string"), spark.createDataFrame(listing, "fact_id bigint, place int, source_id bigint"), spark.createDataFrame(sources, "source_id bigint, text string"))
    found = {r.fact_id: r for r in got.collect()}
    assert len(found) == len(facts) == got.count()
    rank = ["verbatim", "stray tail", "diverges", "not found", "too short", attribution.UNAVAILABLE]
    for fact, quote in facts:
        first = {}
        for place, source in sorted((p, s) for f, p, s in listing if f == fact):
            first.setdefault(source, place)
        outcomes = [(s, *min((judged(quote, t) for k, t in sources if k == s), key=lambda x: rank.index(x[1]), default=(False, attribution.UNAVAILABLE))) for s in sorted(first, key=lambda s: (first[s], s))]
        r, hits = found[fact], [o for o in outcomes if o[1]]
        assert r.verified == bool(hits)
        if hits:
            best = min(first[o[0]] for o in hits)
            assert (r.source_id, r.why) in {(o[0], o[2]) for o in hits if first[o[0]] == best}
            assert any(canonical(r.span) in canonical(t) for s, t in sources if s == r.source_id and t)
        else:
            assert r.source_id is None and r.span == (quote or "") and sorted(r.why.split("; ")) == sorted(f"{s}: {why}" for s, _, why in outcomes)


def test_facts_without_sources_and_empty_tables(spark):
    facts, listing, sources = spark.createDataFrame([(1, "x" * 30)], "fact_id int, quote string"), spark.createDataFrame([], "fact_id int, place int, source_id int"), spark.createDataFrame([], "source_id int, text string")
    assert attribution.attribute(facts, listing, sources).collect() == [(1, None, False, attribution.UNLISTED, "x" * 30)]
    assert attribution.attribute(facts.limit(0), listing, sources).count() == 0
    clash = facts.withColumn("source_id", F.lit(1)).withColumn("place", F.lit(1)).withColumn("why", F.lit(1))
    assert attribution.attribute(clash, listing, sources).count() == 1


@pytest.mark.parametrize("block", [5, 1_000_000])
def test_first_containing_equals_brute_force(spark, block):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 400))) for _ in range(60)]
    quoted = ["".join(rng.choice("abc ") for _ in range(rng.choice([0, 1, 2, 4, 6, 9]))) for _ in range(80)] + [t[5:205] for t in texts[::7]]
    docs = spark.createDataFrame([*enumerate(texts), (60, None), (None, "abc" * 99)], "source_id bigint, text string").repartition(5)
    got = {r.quote: r.source_id for r in attribution.first_containing(spark.createDataFrame([(q,) for q in [*quoted, None]], "quote string"), docs, block).collect()}
    want = {q: next((k for k, t in enumerate(texts) if q in t), None) for q in quoted}
    assert got == {q: k for q, k in want.items() if k is not None}


def test_many_quotations_read_each_source_once(spark):
    words = [f"passage {k} of the order" for k in range(40)]
    sources = spark.createDataFrame([(k, f"so {w}, it says") for k, w in enumerate(words)], "source_id int, text string")
    found = attribution.first_containing(spark.createDataFrame([(w,) for w in [*words, "elsewhere"]], "quote string"), sources, 100)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {r.quote: r.source_id for r in found.collect()} == {w: k for k, w in enumerate(words)}


@pytest.mark.parametrize("span", [1, 16, 1 << 18])
def test_windows_of_parted_texts_have_every_quotation(monkeypatch, span):
    monkeypatch.setattr(attribution, "SPAN_CHARS", span)
    rng = random.Random(span)
    texts = ["".join(rng.choices("ab é😀", k=rng.choice([0, 1, 5, 90]))) for _ in range(40)]
    quoted = sorted({"", *(t[i : i + n] for t in texts for i, n in [(rng.randint(0, 60), rng.randint(1, 40))]), *("".join(rng.choices("ab é😀", k=rng.randint(1, 9))) for _ in range(200))})
    table = np.zeros(1 << 14, np.uint64)
    for batch in attribution.marked(20)(iter([pa.record_batch([pa.array(quoted)], ["quote"]), pa.record_batch([pa.array([""])], ["quote"])])):
        table[batch.column(0).to_numpy()] |= batch.column(1).to_numpy().view(np.uint64)
    batches = (pa.record_batch([pa.array(range(k, k + 10)), pa.array(texts[k : k + 10])], ["source_id", "text"]) for k in (30, 0, 20, 10))
    least = {}
    for batch in attribution.windows(types.SimpleNamespace(value=table), 20, sorted({len(q) for q in quoted}))(batches):
        for q, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            assert q in texts[k]
            least[q] = min(k, least.get(q, k))
    want = {q: next((k for k, t in enumerate(texts) if q in t), None) for q in quoted}
    assert {q: least.get(q) for q in quoted} == want and None in want.values()


def test_canonical_of_a_quotation_is_that_of_a_text():
    rng = random.Random(1)
    letters = [chr(c) for c in [*range(0x20, 0x3400), *range(0xAC00, 0xAC40), *range(0xFF00, 0xFFEF), *([*range(0x1100, 0x1200)] * 3)] if unicodedata.category(chr(c))[0] != "C"]
    letters += ["Σ", "İ", "́", "̧", "া", "ে", "゙", "か", "ﾞ", "ｶ"] * 40
    for _ in range(20000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 12)))
        own = quotes.Canonical(text)
        assert own.text == canonical(text) and len(own.ends) == len(own.text), ascii(text)
    korean = "한국어 문장이 여기 있습니다. 이것은 인용문이며 원본에 그대로 있습니다."
    assert quotes.judge_quote(unicodedata.normalize("NFD", korean), canonical(korean))[:2] == (True, "verbatim")


def test_agreement_on_repetitive_text():
    began = time.process_time()
    assert quotes.agreement("ab" * 4000 + "c", "ab" * 400_000) == 8000
    assert time.process_time() - began < 1
    assert [quotes.agreement("abcd", h) for h in ("", "a", "zabz", "abcd", "xx")] == [0, 1, 2, 4, 0]


def test_sources_are_read_in_batches(spark):
    facts = spark.createDataFrame([(k, f"the quotation of fact number {k} in full") for k in range(5)], "fact_id int, quote string")
    listing = spark.createDataFrame([(k, 0, k) for k in range(5)], "fact_id int, place int, source_id int")
    sources = spark.createDataFrame([(k, f"It says the quotation of fact number {k} in full, and more") for k in range(4)], "source_id int, text string")
    got = attribution.attribute(facts, listing, sources)
    assert "CoGroup" not in got._jdf.queryExecution().toString()  # a call for each source costs more than its quotations
    assert [(r.fact_id, r.source_id) for r in got.orderBy("fact_id").collect()] == [(0, 0), (1, 1), (2, 2), (3, 3), (4, None)]


def test_canonical_form_is_that_of_a_table_and_a_pattern():
    rng, marks = random.Random(4), [*map(chr, FOLD), "a", "B", "é", "é", "x.JPG", ".gif", "y.pngs", "İ", ".gıf", "\\u2019", " ", "\n", "\u3000", "ﬁ", "…", "∕"]
    for _ in range(5000):
        text = "".join(rng.choices(marks, k=rng.randint(0, 14)))
        assert canonical(text) == " ".join(IMAGE_NAME.sub(" ", unicodedata.normalize("NFKC", decoded(text)).translate(FOLD)).split()).lower()


def test_a_long_run_without_blanks_is_read_once():
    began = time.perf_counter()
    assert len(canonical("x" * 200_000)) == 200_000
    assert time.perf_counter() - began < 2  # the pattern alone reads it from each of its characters
