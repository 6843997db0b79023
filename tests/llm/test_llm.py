"""The training-data operators against libraries, brute force and hand-made cases; nulls, empties, repeats, clashing names."""

import functools
import hashlib
import html
import math
import random
import re
import time
import tracemalloc
import zlib

import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import bpe, common, components, decontaminate, html_extract, langid, ngram_join, quality, queries, shingles, substring_dedup, token_counts, token_store, url_filter

BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", " ", "\n", "a  b\n c", "it's 'tis we'll !!'s", "ΑΣ İ ﬁ é", "x<|endoftext|>y <|EndOfText|>", "a" * 3000, "the " * 700, "\x1c\x00 tab\tend ", "中文字 😀 ① 12", "▁ ▁▁x", "é́"]
SCHEMA = "doc_id bigint, text string, ids string, n_tokens string, lang string"


def odd_docs(spark, more=()):
    rows = [(k, t, "x", "y", None) for k, t in enumerate([*ODD, *more])] + [(9000, None, None, None, "en"), (9000, None, None, None, "en"), (None, "no id here", None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def noise(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("etaoin shr'.,1é\n ΣAT") for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_bpe(spark):
    docs = odd_docs(spark, noise(1, 300))
    lib = Tokenizer.from_file(BPE)
    got = bpe.decode(bpe.encode(docs, BPE), BPE).join(docs.select("doc_id", "text").distinct(), "doc_id").collect()
    assert len(got) == len(ODD) + 302
    for r in got:
        want = lib.encode(r.text or "", add_special_tokens=False).ids
        assert [int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4)] == want and r.n_tokens == len(want)
        assert r.decoded == lib.decode(want, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0), BPE).count() == 0


def test_bpe_long_words_and_forgetting(monkeypatch):
    lib, monkeypatch = Tokenizer.from_file(BPE), monkeypatch
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(bpe, "TOGETHER", 200)
    e = bpe.Encoder(bpe.Vocabulary(BPE))
    texts = [*noise(2, 60), "abc" * 2000, "<|endoftext|>"]
    ids, counts = e.encode(texts)
    at = 0
    for t, n in zip(texts, counts, strict=True):
        assert ids[at : at + n].tolist() == lib.encode(t, add_special_tokens=False).ids
        at += n


def test_bpe_in_one_worker(spark):
    """Encoding and decoding share the worker of a task: a second one would have the vocabulary, too."""
    import corpus_pipeline

    docs = odd_docs(spark, noise(7, 50))
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(bpe.encode_decode(docs, BPE)) == rows(bpe.decode(bpe.encode(docs, BPE), BPE))
    for out in (corpus_pipeline.bpe_codes(spark, docs, SMALL), queries.op1_bpe(spark, SMALL)):
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_bpe_memory():
    """What an encoder takes at once besides its table follows a group of texts, not the batch."""
    e = bpe.Encoder(bpe.Vocabulary(BPE))
    texts = [" ".join(noise(k, 60)) for k in range(800)]
    e.encode(texts[:1])
    tracemalloc.start()
    try:
        e.encode(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(map(len, texts)) > 1 << 20 and most < 40 << 20, most


def test_token_counts(spark):
    docs = odd_docs(spark, noise(3, 300))
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in token_counts.count_tokens(docs, PIECES, limit=50).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        n = len(lib.encode(r.text or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 50)


def test_store(spark, tmp_path):
    docs, folder = odd_docs(spark, noise(4, 50)), str(tmp_path / "store")
    token_store.write_store(docs, BPE, folder)
    got = {}
    for r in token_store.read_store(spark, folder).collect():
        got.setdefault(r.doc_id, []).append(r)
    lib, at = Tokenizer.from_file(BPE), 0
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    for key, text in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        r = sorted(got[key], key=lambda r: r.start)[0 if key != 9000 or at == sorted(got[key], key=lambda r: r.start)[0].start else 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(raw))
        at += len(ids)
    assert [x.tolist() for x in token_store.get(spark, folder, 9000)] == [[2], [2]] and token_store.get(spark, folder, 12345) == []


def test_urls(spark):
    rows = [(1, "http://A.com/x?q"), (2, "http://a.com"), (3, "ftp://www.example.com/en/1"), (4, "http://b.example.com/en/"), (5, "http://x.org/a.com/b"), (6, None), (7, "no scheme"), (8, "http://m.net/fr/#f"), (9, "http://casino.org/a"), (9, "http://casino.org/a")]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id int, url string")).collect()
    assert sorted({(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got}) == [(1, "a.com", "/x", "com/", "allow"), (2, "a.com", "", None, "allow"), (3, "www.example.com", "/en/1", "www.example.com/en/", "allow"), (4, "b.example.com", "/en/", "example.com/en/", "block"), (5, "x.org", "/a.com/b", None, "allow"), (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "m.net", "/fr/", "net/fr/", "block"), (9, "casino.org", "/a", None, "block")]
    assert len(got) == 10


PAGE = '<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li>menu</ul></nav><div class="ad">buy</div><article><h1>A &amp; B</h1><p><b>One\n two<br>three<p>Four</p><div class="comments"><p>reader</p></div></article><footer>&copy;</footer><!-- x'


def test_html(spark):
    plain = lambda k: f"<body><div><p>Follow us on our channels</p></div><div><p>Body text number {k}</p></div>"
    rows = [(0, "http://h.org/", PAGE), (1, None, None), (2, "http://h.org/", ""), (3, "x", "<p>a < b</p><p>unclosed <i>it")] + [(10 + k, "http://site.org/x", plain(k)) for k in range(12)]
    got = {r.page_id: r for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got[0].text == "A & B\nOne two three\nFour" and got[0].n_chars == len(got[0].text)
    assert (got[1].text, got[2].text, got[3].text) == ("", "", "a < b\nunclosed it")
    assert got[15].text == "Body text number 5"  # the line on every page of the host is its template


def test_html_keeps_article_words():
    text = lambda h: html_extract.Page(h).extract()
    assert text('<article><p>Text <span class="share">42%</span> of <a class="related" href="#">the market</a></p><p>x <math><mi>a</mi></math> <label>l</label></p></article>') == "Text 42% of the market\nx a l"
    assert text('<article><div class="share">tweet</div><p>kept</p><form>no</form></article>') == "kept"
    assert text("<p>a<p title='x>y'>b<div>c</div>") == "a\nb\nc"
    assert text("<p>1 < 2 <3 &lt;b&gt;</p><!doctype x><?php y ?><") == "1 < 2 <3 <b>\n<"
    assert text("a<b title=\"never closed>c") == "a" and text("<p>cut <b") == "cut"
    assert text("<table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul>") == "a\nb\nc\nd\ne"


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "deep", "<b>" * 100_000 + "deep", "<p><table><tr><td>" + "<span>" * 30_000 + "<h1></h1>" * 30_000 + "deep", '<a "' * 50_000 + ">deep", "<a href='" * 100_001])
def test_html_is_linear(page):
    began = time.time()
    assert html_extract.Page(page).extract() in ("deep", "")
    assert time.time() - began < 10


def brute_templates(pages):
    """Keys that recur on enough distinct contents of a host, by plain counting."""
    seen, contents = {}, {}
    for host, source in pages:
        content, keys = html_extract.Page(source).subtrees()
        contents.setdefault(host, set()).add(content)
        for k in keys:
            seen.setdefault((host, k), set()).add(content)
    bounds = {1: (html_extract.PAGES_INSIDE, html_extract.SHARE_INSIDE), 0: (html_extract.PAGES_OUTSIDE, html_extract.SHARE_OUTSIDE)}
    least = lambda host, k: max(bounds[k & 1][0], bounds[k & 1][1] * len(contents[host]))
    out = {}
    for (host, k), on in seen.items():
        if len(on) >= least(host, k):
            out.setdefault(host, set()).add(k)
    return out


def test_templates_equal_brute_force_and_do_the_work(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = pages.collect()
    host = lambda url: (re.search("://([^/?#]*)", url or "") or [None, ""])[1].lower()
    found = brute_templates([(host(r.url), r.html) for r in rows if r.html])
    assert len(found) >= 50 and len({host(r.url) for r in rows}) == 60
    plain = {r.page_id: r.text for r in html_extract.extract_text(pages, lists=False).collect()}
    full = {r.page_id: r.text for r in html_extract.extract_text(pages).collect()}
    for r in rows:
        assert plain[r.page_id] == (html_extract.Page(r.html).extract(found.get(host(r.url), set()), False) if r.html else "")
        assert full[r.page_id] == (html_extract.Page(r.html).extract(found.get(host(r.url), set())) if r.html else "")
    # by templates alone, the menus and footers that recur on three pages of their host or more have gone
    on, gone = {}, 0
    for r in rows:
        for part in re.findall(r"<nav>.*?</nav>|<footer>.*?</footer>", r.html or "", re.S):
            on.setdefault((host(r.url), part), []).append(r.page_id)
    for (_, part), ids in on.items():
        words = " ".join(html.unescape(re.sub("<[^>]*>", " ", part)).split())
        if len({full[i] for i in ids}) >= 4 and len(words) > 40:  # a menu of one short word may be in any text
            assert not any(words in " ".join(plain[i].split()) for i in ids)
            gone += len(ids)
    assert gone > 300


def test_html_edge_cases(spark):
    schema = "page_id int, url string, html string, host string, templates int, tree int"
    assert html_extract.extract_text(spark.createDataFrame([], schema)).columns == ["page_id", "url", "text", "n_chars"]
    rows = [(None, "http://a.b/", "<p>x</p>", "h", 1, 2), (1, None, None, None, None, None), (1, None, None, None, None, None), (2, "u", "w " * 300_000, None, None, None)]
    got = html_extract.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 0), (1, 0), (2, 599_999)]


def test_langid(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = langid.predict(docs.unionByName(spark.createDataFrame([(-1, None), (-2, "12 !!"), (None, "the and of")], "doc_id bigint, text string"), allowMissingColumns=True), langid.learn(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id", "left").where(langid.held_out("doc_id")).collect()
    known = [r for r in rows if r.lang]
    assert sum(r.lang == r.lang_pred for r in known) >= 0.95 * len(known) and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id: r.lang_pred for r in found.where("doc_id < 0").collect()} == {-1: "und", -2: "und"}
    assert langid.predict(docs.limit(3), {}).select("lang_pred").distinct().first()[0] == "und"


def test_automaton_parses_longest_matches():
    model = langid.Model({"x": "abcab", "y": "zzz"})
    rates, _ = model.rates(["abca bz", None])
    def phrases(text, sample):
        n, i = 0, 0
        while i < len(text):
            k = 1
            while i + k < len(text) and text[i : i + k + 1] in sample:
                k += 1
            n, i = n + 1, i + k
        return n
    assert round(rates[0][0] / model.bits[0] * 7) == phrases("abca bz", "abcab")


def base_rules(text):
    words = WORD.findall(text or "")
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + d for p in seen.values() if len(p) > 1 for i in p for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    docs = odd_docs(spark, ["a b c a b c a b", "l\nl\n \nl#*", *noise(5, 40)]).select("doc_id", "text", F.lit(1).alias("kept"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id bigint, quality int")
    for r in quality.judge(docs, labels).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == base_rules(r.text)
        assert r.base_failed == (got[0] < 50 or 100 * got[4] > 50 * got[0]) and not (r.kept and r.base_failed)


def brute_scores(rows, trusted):
    """The mean log ratio of each text's hashed words, word pairs and endings, by plain counting."""
    mask = (1 << 64) - 1
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    chain = lambda *parts: functools.reduce(lambda seed, p: xxhash.xxh64_intdigest(p, seed=seed & mask), parts, 42)
    bucket = lambda *parts: signed(chain(*(x.encode() if isinstance(x, str) else x.to_bytes(4, "little") for x in parts))) % quality.BUCKETS
    grams, raw, target = {}, {}, {}
    for k, (i, text) in enumerate(rows):
        ws = WORD.findall(text or "")
        grams[k] = [bucket(w) for w in ws] + [bucket(a, b) for a, b in zip(ws, ws[1:], strict=False)] + [bucket_int(chain, signed, w) for w in ws]
        for g in grams[k]:
            raw[g] = raw.get(g, 0) + 1
            target[g] = target.get(g, 0) + (i in trusted)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    of = lambda g: math.log((target[g] + quality.SMOOTHING) / (n_target + quality.SMOOTHING * quality.BUCKETS)) - math.log((raw[g] + quality.SMOOTHING) / (n_raw + quality.SMOOTHING * quality.BUCKETS))
    return [sum(map(of, gs)) / len(gs) if gs else 0.0 for gs in grams.values()]


def bucket_int(chain, signed, word):
    """The bucket of a word's ending: Spark hashes the whole number 3 after it."""
    h = xxh_int(3, chain(word[-3:].encode()))
    return signed(h) % quality.BUCKETS


def xxh_int(value, seed):
    """Spark's xxhash64 of a 32-bit whole number."""
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), seed=seed)


def test_quality_score_and_verdict_equal_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    trusted = {r.doc_id for r in labels.where("quality = 1").collect()}
    want = dict(zip([i for i, _ in rows], brute_scores(rows, trusted), strict=True))
    for r in quality.judge(docs, labels).collect():
        assert abs(r.score - want[r.doc_id]) < 1e-6
        assert r.kept == (not r.base_failed and want[r.doc_id] >= quality.THRESHOLD)


def test_quality_fitted_on_one_half_judges_the_other(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    rows = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(labels, "doc_id").where("not base_failed and doc_id % 2 = 1").collect()
    good, low = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert len(good) > 1000 and len(low) > 100 and sum(good) >= 0.99 * len(good) and sum(low) <= 0.02 * len(low)


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1)], "doc_id bigint, quality int")
    schema = "doc_id bigint, text string, id int, good int, bucket int, score string"
    assert quality.judge(spark.createDataFrame([], schema), labels).count() == 0
    rows = [(1, "w " * 200_000, 1, 1, 1, "x"), (None, "one two", None, None, None, None), (1, None, None, None, None, None)]
    got = quality.judge(spark.createDataFrame(rows, schema), labels).collect()
    assert sorted((r.n_words, r.kept) for r in got) == [(0, False), (2, False), (200_000, False)]
    assert all(r.score == 0 for r in quality.judge(spark.createDataFrame(rows, schema), labels.limit(0)).collect())


def near_docs():
    rng, docs = random.Random(6), []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    for k in range(40):
        base = [word() for _ in range(rng.randint(30, 200))]
        docs.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            docs.append(" ".join(copy))
        if k % 5 == 0:
            docs.append(" ".join([*(word() for _ in range(100)), passage, *(word() for _ in range(100))]))
    return docs, passage


def brute_groups(texts):
    sets = [set(s.tolist()) for s in shingles.sets_of(texts)]
    root = list(range(len(sets)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(sets))], [len(s) for s in sets]


@pytest.mark.parametrize("broadcast", [True, False])
def test_join(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(ngram_join, "MOST_IDS", 0)
        monkeypatch.setattr(ngram_join, "MOST_ROOTS", 0)
    texts = [*near_docs()[0], "", "one two", "One TWO", None, "a b c d e", "A b c d e", *ODD]
    docs = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)] + [(None, "one two", 0)], "doc_id bigint, text string, n int")
    groups, sizes = brute_groups(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {k: (n, g) for k, (n, g) in enumerate(zip(sizes, groups, strict=True))} | {None: (1, None)}
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("share", "groupings"), [(10**9, 3), (0, 2)])
def test_star_turns_end_when_they_link_little(spark, monkeypatch, share, groupings):
    """A pair that only a further turn finds, as both meet a longer document first: its link counts, whether groups and lists are made anew for it or not."""
    calls, real = [], ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda edges: calls.append(1) or real(edges))
    monkeypatch.setattr(ngram_join, "LONG_LIST", 1)
    monkeypatch.setattr(ngram_join, "YIELD", share)
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    texts = [words("x", 60) + " " + words(f"n{k}y", 60) for k in range(10)] + [words("x", 60), words("x", 60) + " more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert got == dict(enumerate(brute_groups(texts)[0])) and got[11] == 10
    assert len(calls) == groupings


def test_bits_bound_overlap():
    rng = random.Random(7)
    for n in (5, 600, 3000):
        pool = [f"w{rng.randrange(n)}" for _ in range(3 * n)]
        a, b = shingles.sets_of([" ".join(pool[: 2 * n]), " ".join(pool[n:])])
        assert ngram_join.differing_bits(ngram_join.signature(a), ngram_join.signature(b)) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_substrings(spark):
    texts, passage = near_docs()
    rows = [(k, t) for k, t in enumerate(texts) if passage in t] + [(500, "only here " + passage[:40]), (501, None), (502, ""), (502, ""), (None, passage)]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    first = min(k for k, t in rows if k is not None and t and passage in t)
    for r in out:
        old = dict(rows)[r.doc_id]
        if r.doc_id in (first, 500, 501, 502, None):
            assert r.text == old and r.n_removed == 0 and r.spans == []
        else:
            assert passage not in r.text and r.n_removed == len(old) - len(r.text)
            assert 0.6 * len(passage) <= r.n_removed <= len(passage) + 60
    assert len(out) == len(rows)


@pytest.mark.parametrize("letters,length", [([chr(0x4E00 + k) for k in range(3000)], 200), ([chr(0xE01 + k) for k in range(46)], 200), (list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 400)])
def test_substrings_without_spaces(spark, letters, length):
    rng = random.Random(9)
    run = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passage, whole = run(length), run(900)
    rows = [(1, run(700) + passage + run(700)), (2, whole)]
    rows += [(10 + k, run(rng.randint(0, 900)) + passage + run(rng.randint(0, 900))) for k in range(30)]
    rows += [(60, "short line\n" + passage + "\nshort line"), (61, whole), (62, run(2000))]
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for k, old in rows:
        if k in (1, 2, 62):
            assert out[k].text == old
        elif k == 61:
            assert out[k].text == ""
        else:
            assert 0.4 * length <= out[k].n_removed <= length


def brute_removed(rows):
    """The union of each document's passages that occur as passages of a document with a smaller id."""
    spans = [(i, raw, substring_dedup.passages(raw)) for i, raw in rows]
    first = {}
    for i, raw, own in spans:
        for a, b in own:
            first[raw[a:b]] = min(first.get(raw[a:b], i), i)
    out = {}
    for i, raw, own in spans:
        gone = {k for a, b in own if first[raw[a:b]] < i for k in range(a, b)}
        out[i] = bytes(c for k, c in enumerate(raw) if k not in gone).decode()
    return out


@pytest.mark.parametrize("share", [10_000, 5])
def test_substrings_equal_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", share)
    texts, _ = near_docs()
    rng = random.Random(12)
    line = " ".join(f"common{k}" for k in range(40))
    chunks = [" ".join(f"v{rng.randrange(5000)}" for _ in range(200)) for _ in range(60)]
    parts = [c[a : a + 60] for c in chunks for a in [c.index(" ", 100)]]
    texts = [*texts, *chunks, "".join(parts), *(f"{rng.random()} {line} {rng.random()}" for _ in range(40)), "", "é " * 900, "é " * 901, "a" * 5000, "b" + "a" * 5000]
    rows = list(enumerate(texts))
    want = brute_removed([(i, t.encode()) for i, t in rows])
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == want
    stitched = len(near_docs()[0]) + len(chunks)
    assert got[stitched] == texts[stitched]  # put together from pieces of 60 documents that never stood together
    assert len(got[len(texts) - 1]) < 2100 and len(got[len(texts) - 3]) < 1200  # periodic texts after one insertion


def test_passages_resist_insertions_and_are_bounded():
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400)).encode()
    shifted = b"inserted words here " + text
    own = {text[a:b] for a, b in substring_dedup.passages(text)}
    assert len(own & {shifted[a:b] for a, b in substring_dedup.passages(shifted)}) > 0.9 * len(own)
    for raw in (b"a" * 100_000, "é".encode() * 50_000, b"", b" " * 5000):
        edges = substring_dedup.borders(raw)
        assert max([b - a for a, b in zip(edges, edges[1:], strict=False)], default=0) <= substring_dedup.MAX_BYTES and edges[-1] == len(raw)
        assert all(raw[e] & 0xC0 != 0x80 for e in edges[:-1])


def test_substring_edge_cases(spark):
    schema = "doc_id bigint, text string, d1 string, at string, id string, spans int"
    empty = substring_dedup.remove_repeats(spark.createDataFrame([], schema))
    assert empty.columns == ["doc_id", "text", "n_removed", "spans"] and empty.count() == 0
    whole = " ".join(f"w{k}" for k in range(60))
    rows = [(1, whole, "x", "y", "z", 1), (2, whole, None, None, None, None), (2, whole, None, None, None, None), (None, whole, None, None, None, None), (3, None, None, None, None, None)]
    got = sorted(((r.doc_id or 0, r.text) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(0, whole), (1, whole), (2, ""), (2, ""), (3, None)], key=str)


def test_leaks(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    items = [[word() for _ in range(rng.randint(5, 90))] for _ in range(60)]
    docs, want = [], set()
    for k in range(120):
        own = [word() for _ in range(rng.randint(0, 3000))]
        if k % 2:
            item, part = rng.randrange(60), rng.choice([1.0, 0.95, 0.5])
            own[5:5] = items[item][: max(1, int(len(items[item]) * part))]
        docs.append(" ".join(own))
    item_sets, doc_sets = ([set(s.tolist()) for s in shingles.sets_of(x)] for x in ([" ".join(i) for i in items], docs))
    want = {(d, i) for d, x in enumerate(doc_sets) for i, y in enumerate(item_sets) if 100 * len(x & y) >= 80 * len(y)}
    frame = spark.createDataFrame([*enumerate(docs), (900, None), (901, "")], "doc_id bigint, text string")
    bench = spark.createDataFrame([*enumerate(" ".join(i) for i in items), (99, None), (98, "")], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contained_items(frame, bench).collect()} == want and want
    assert decontaminate.drop_contaminated(frame, bench).count() == 122 - len({d for d, _ in want})
    assert decontaminate.contained_items(frame, bench.limit(0)).count() == 0


def test_leaks_of_short_items(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    items = [[word() for _ in range(1 + k % 24)] for k in range(240)]
    docs = []
    for k in range(480):
        own = [word() for _ in range(rng.randint(0, 600))]
        at = rng.randint(0, len(own))
        own[at:at] = items[k // 2] if k % 2 else items[k // 2][:-1]
        docs.append(" ".join(own))
    docs += [" ".join(items[2]).upper(), "\n".join(items[3])]
    runs = lambda words, n: {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    want = set()
    for d, text in enumerate(docs):
        own = text.lower().split()
        for i, item in enumerate(items):
            n = min(5, len(item))
            have, need = runs(own, n), runs(item, n)
            if 100 * len(have & need) >= 80 * len(need):
                want.add((d, i))
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(" ".join(i) for i in items)), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in decontaminate.contained_items(frame, bench).collect()}
    assert set(got) == want and {(2 * i + 1, i) for i in range(240)} <= want
    assert got[(3, 1)] == (1, 1)


def greedy_bits(text, sample):
    """Bits a symbol of a text parsed into longest matches of a sample, in blocks, by plain search."""
    bits = math.log2(max(len(sample), 2))
    phrases = 0
    for a in range(0, len(text), langid.BLOCK):
        block, i = text[a : a + langid.BLOCK], 0
        while i < len(block):
            k = 1
            while i + k < len(block) and block[i : i + k + 1] in sample:
                k += 1
            phrases, i = phrases + 1, i + k
    return phrases * bits / len(text)


def greedy_langs(rows, samples):
    """The language of each text whose plain parse needs the fewest bits, and the score."""
    plain = lambda t: "".join(map(chr, langid.squeezed(langid.letters_of(t)).tolist()))
    own = {lang: plain(t)[: langid.SAMPLE_CHARS] for lang, t in sorted(samples.items())}
    out = {}
    for i, text in rows:
        symbols = plain(text or "")
        if not symbols.strip("\0"):
            out[i] = ("und", 0.0)
            continue
        rates = [(greedy_bits(symbols, s), lang) for lang, s in own.items()]
        best = min(rates)
        out[i] = (best[1], 1 - best[0] / min(x for x, lang in rates if lang != best[1]))
    return out


def test_langid_query_equals_a_plain_parser(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = greedy_langs([r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0], langid.learn(docs))
    got = {r.doc_id: r for r in queries.op6_langid(spark, SMALL).collect()}
    assert len(got) == len(rows)
    for i, (lang, score) in want.items():
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-9
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_langid_edge_cases(spark):
    schema = "doc_id bigint, text string, lang string, id int, part int, place int"
    assert langid.learn(spark.createDataFrame([], schema)) == {}
    labels = [(k, "same words here", lang, 1, 1, 1) for k, lang in enumerate(["b", "a", "a", None] * 5)]
    docs = spark.createDataFrame([*labels, (None, "null id", "c", None, None, None), (100, None, "d", None, None, None)], schema)
    samples = langid.learn(docs)
    assert set(samples) == {"a", "b"}  # neither the null id nor the null text is learned from
    assert langid.predict(docs.where("id = 1").select("doc_id", "text"), {"b": "same words", "a": "same words"}).where("lang_pred <> 'a'").isEmpty()  # ties go to the first by name
    long = spark.createDataFrame([(1, "the words " * 100_000, "z", 1, 1, 1), (1, "", "z", 1, 1, 1)], schema)
    short = langid.best(langid.Model(samples), ["the words " * 20_000])[0]  # a long text is told as its beginning is, all of it being alike
    assert sorted(r.lang_pred for r in langid.predict(long, samples).collect()) == sorted([*short, "und"])


@pytest.mark.parametrize("schema", ["doc_id bigint, text string, id int, n int, token int, centre int, root int, node int, count int, set string"])
def test_empty_tables_and_clashing_names(spark, tmp_path, schema):
    docs = spark.createDataFrame([], schema)
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id bigint, text string")
    assert ngram_join.jaccard_components(docs).count() == ngram_join.keep_representatives(docs).count() == 0
    assert decontaminate.contained_items(docs, items).count() == decontaminate.drop_contaminated(docs, items).count() == 0
    assert token_counts.count_tokens(docs, PIECES).count() == bpe.encode(docs, BPE).count() == 0
    token_store.write_store(docs, BPE, str(tmp_path / "none"))
    assert token_store.read_store(spark, str(tmp_path / "none")).count() == 0
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id bigint, url string, host int, rule int")).count() == 0
    full = spark.createDataFrame([(1, "one two three four five six seven", *range(7), "s"), (1, "one two three four five six seven", *range(7), "s"), (2, "one two three four five six seven", *range(7), "s"), (None, "one two three four five six", *range(7), "s")], schema)
    assert sorted((r.doc_id or 0, r.component_id) for r in ngram_join.jaccard_components(full).collect()) == [(0, None), (1, 1), (1, 1), (2, 1)]
    assert sorted((r.doc_id or 0, r.item_id) for r in decontaminate.contained_items(full, items).collect()) == [(0, 1), (1, 1), (1, 1), (2, 1)]


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    samples = langid.learn(docs)
    bench = [set(ngrams(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    lib = Tokenizer.from_file(BPE)
    final = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = sorted((tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()), key=lambda r: r[0])
        out = stage(spark, docs, SMALL)
        rows = sorted((tuple(r) for r in out.collect()), key=lambda r: r[0])
        if name == "language_id":
            told = greedy_langs([(r[0], r[1]) for r in before if not r[2] or not any(c.isalpha() for c in r[1] or "")], samples)
            want = [(*r[:2], r[2] or told[r[0]][0], *r[3:]) for r in before if told.get(r[0], ("",))[0] != "und"]
        elif name == "ngram_jaccard_join":
            groups, _ = brute_groups([r[1] for r in before])
            want = [r for i, r in enumerate(before) if groups[i] == i]
        elif name == "substring_dedup":
            cut = brute_removed([(r[0], (r[1] or "").encode()) for r in before])
            want = [r if cut[r[0]] == (r[1] or "") else (r[0], cut[r[0]], r[2], r[3], len(cut[r[0]])) for r in before]
        elif name == "benchmark_decontamination":
            want = [r for r in before if not any(b and 100 * len(b & set(ngrams(r[1]))) >= 80 * len(b) for b in bench)]
        else:
            ids = {r[0]: lib.encode(r[1] or "", add_special_tokens=False).ids for r in before}
            assert [(r[0], r[1], [int.from_bytes(r[2][a : a + 4], "little") for a in range(0, len(r[2]), 4)]) for r in rows] == [(i, len(x), x) for i, x in ids.items()]
            assert all(r[3] == hashlib.sha256(r[2]).hexdigest() and r[4] == hashlib.sha256(lib.decode(ids[r[0]], skip_special_tokens=False).encode()).hexdigest() for r in rows)
            final = rows
            break
        assert rows == want and len(rows) >= 0.7 * len(before), name
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert final


def ngrams(text):
    """The five-word shingles of a text; the whole sequence where it has fewer words."""
    ws = [re.sub("[A-Z]+", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return [tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))] if ws else []


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, spans int, lang_pred int"
    rows = [(1, None, None, None, None, 1, 1, 1), (2, "", "en", "s", 0, 1, 1, 1), (3, "word " * 50_000, None, "s", None, 1, 1, 1), (3, "word " * 50_000, None, "s", None, 1, 1, 1), (None, "a null id", "en", None, 3, 1, 1, 1)]
    for content in ([], rows):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, spark.createDataFrame(content, schema), SMALL)
            assert name == "bpe" or out.columns == corpus_pipeline.COLUMNS
            assert out.count() == (0 if not content else {"language_id": 3}.get(name, len(rows))), name


@pytest.mark.parametrize("few", [components.FEW, 0])
def test_components_equal_union_find(spark, monkeypatch, few):
    """A chain, a star, random edges, self edges and repeated edges; dealt out by number, and left to Spark."""
    monkeypatch.setattr(components, "FEW", few)
    monkeypatch.setattr(components, "A_TASK", 50)
    r = random.Random(11)
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + k) for k in range(1, 120)] + [(r.randrange(300, 700), r.randrange(300, 700)) for _ in range(200)] + [(5, 5), (900, 901), (900, 901), (901, 900)]
    parent: dict[int, int] = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    got = [tuple(x) for x in components.components(spark.createDataFrame([*edges, (None, 1), (2, None)], "a long, b long")).collect()]
    assert len(got) == len(set(got)) and set(got) == {(k, top(k)) for k in parent if top(k) != k}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_are_not_shuffled_to_drop_contaminated_ones(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(k, item if k == 3 else f"nothing of it in {k}") for k in range(20)], "doc_id long, text string")
    left = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert "SortMergeJoin" not in left._jdf.queryExecution().toString()
    assert sorted(r.doc_id for r in left.collect()) == [k for k in range(20) if k != 3]


def shuffled_texts(df):
    """Rows with a text that the exchanges of `df` wrote, once it has run."""

    def below(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return below(node.finalPhysicalPlan())
        if kind.endswith("QueryStageExec"):
            return below(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" and "text#" in node.output().toString() else 0
        return own + sum(below(node.children().apply(k)) for k in range(node.children().size()))

    return below(df._jdf.queryExecution().executedPlan())


def test_only_texts_that_change_are_shuffled(spark):
    """Where neither table of a join fits a broadcast, as over large inputs."""
    item = "one two three four five six seven eight nine ten eleven twelve"
    whole = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(k, {3: item, 7: whole, 11: whole}.get(k, f"nothing of it in {k}")) for k in range(40)] + [(None, whole)], "doc_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        cut = substring_dedup.remove_repeats(docs)
        assert {r.doc_id: r.n_removed for r in cut.collect()} == {k: len(whole) if k == 11 else 0 for k in [*range(40), None]}
        clean = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
        assert {r.doc_id for r in clean.collect()} == {k for k in [*range(40), None] if k != 3}
        first = ngram_join.keep_representatives(docs)
        assert {r.doc_id for r in first.collect()} == {k for k in [*range(40), None] if k != 11}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [shuffled_texts(x) for x in (cut, clean, first)] == [1, 1, 1]


@pytest.mark.parametrize("words", [1, common.BIT_WORDS])
def test_parted_loses_no_row(spark, monkeypatch, words):
    """However many ids share a bit; ids may repeat, be null or of another integer type."""
    monkeypatch.setattr(common, "BIT_WORDS", words)
    ids = [*range(-50, 150), 7, 7, None]
    docs = spark.createDataFrame([(k, 1, 2, 3) for k in ids], "id int, word int, bits int, bit int")
    wanted = spark.createDataFrame([(k,) for k in [*range(0, 500, 9), None]], "id long")
    surely_not, may = (sorted(r.id if r.id is not None else 999 for r in x.collect()) for x in common.parted(docs, wanted, "id"))
    assert sorted(surely_not + may) == sorted(999 if k is None else k for k in ids)
    assert not set(surely_not) & set(range(0, 500, 9)) and common.without(docs, wanted, "id").columns == docs.columns
    assert common.without(docs, wanted, "id").count() == sum(k is None or k < 0 or k % 9 > 0 for k in ids)
    assert common.without(docs, wanted.limit(0), "id").count() == len(ids)
