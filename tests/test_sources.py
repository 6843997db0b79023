"""Sharded scans with their vintage, sinks that are byte-stable and complete, glyphs of PDF texts."""

import json
import os
import random
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import glyphs
from ledgerline.sources import shards, sinks
from ledgerline.sources.shipping import BATCH_BYTES, ship


def block(rows, **drop):
    out = {name: [r[k] for r in rows] for k, name in enumerate(["accessionNumber", "form", "filingDate", "reportDate", "items", "primaryDocument", "primaryDocDescription"])}
    return {k: v for k, v in out.items() if k not in drop}


def row(day, k=0):
    return (f"{day}-{k}", " 10-K ", day, "" if k else day, "5.02,9.01", "d.htm", "text")


@pytest.fixture
def folder(tmp_path):
    shard = lambda name, first, last: {"name": name, "filingFrom": first, "filingTo": last}
    main = {"filings": {"recent": block([row("2024-01-02"), row("2023-06-01", 1)]), "files": [shard("a.json", "2020-01-01", "2023-05-31"), shard("b.json", "2015-01-01", "2019-12-31"), shard("c.json", "2000-01-01", "2014-12-31")]}}
    (tmp_path / "co.json").write_text(json.dumps(main))
    (tmp_path / "co_a.json").write_text(json.dumps(block([row("2020-01-01"), row("2022-02-02")], items=1, reportDate=1)))
    (tmp_path / "co_b.json").write_text(json.dumps(block([row("2015-01-01")])))
    (tmp_path / "co_c.json").write_text("{broken")
    (tmp_path / "fetch-log.json").write_text(json.dumps({"co.json": "2024-02-01T00:00:00Z"}))
    os.utime(tmp_path / "co_a.json", (1_600_000_000, 1_600_000_000))
    return tmp_path


@pytest.mark.parametrize("back_to,opened", [("2023-07-01", ["co.json"]), ("2023-06-01", ["co.json"]), ("2021-01-01", ["co.json", "co_a.json"]), ("2020-01-01", ["co.json", "co_a.json"]), ("2016-01-01", ["co.json", "co_a.json", "co_b.json"])])
def test_only_needed_shards_are_opened(spark, folder, back_to, opened):
    got = shards.read_filings(spark, str(folder), "co", back_to)
    assert sorted({r.file for r in got.collect()}) == opened == sorted(os.path.basename(f) for f in got.inputFiles() if not f.endswith(shards.LOG))


def test_rows_and_their_vintage(spark, folder):
    got = {r.accession: r for r in shards.read_filings(spark, str(folder), "co", "2021-01-01").collect()}
    assert len(got) == 4
    newest, old = got["2024-01-02-0"], got["2020-01-01-0"]
    assert (newest.form, str(newest.filing_date), str(newest.report_date), newest.as_of, newest.as_of_basis) == ("10-K", "2024-01-02", "2024-01-02", "2024-02-01T00:00:00Z", shards.RECORDED)
    assert got["2023-06-01-1"].report_date is None
    assert (old.items, old.report_date, old.as_of, old.as_of_basis) == ("", None, "2020-09-13T12:26:40Z", shards.BY_FILE)


def test_broken_and_missing_files(spark, folder):
    with pytest.raises(Exception, match="MALFORMED"):
        shards.read_filings(spark, str(folder), "co", "2001-01-01").collect()
    (folder / "co_b.json").unlink()
    (folder / "fetch-log.json").unlink()
    assert shards.read_filings(spark, str(folder), "co", "2021-01-01").where(F.col("as_of_basis") == shards.BY_FILE).count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        shards.read_filings(spark, str(folder), "co", "2016-01-01").collect()
    (folder / "empty.json").write_text('{"filings": {"recent": {}}}')
    assert shards.read_filings(spark, str(folder), "empty", "2016-01-01").count() == 0


def test_needed_shards():
    files = [("a", "2010-01-01", "2012-01-01"), ("b", "2005-01-01", "2009-01-01")]
    assert shards.needed(None, files, "2006-01-01") == ["a", "b"]
    assert shards.needed("2011-01-01", files, "2010-06-01") == ["a"]
    assert shards.needed("2009-06-01", files, "2009-05-01") == ["b"]  # a is newer than all that is known
    assert shards.needed("2011-01-01", [], "2000-01-01") == []


def content(path):
    return [b"".join(p.read_bytes() for p in sorted(f.glob("part-*"))) for f in sorted(Path(path).rglob("*")) if f.is_dir() and list(f.glob("part-*"))]


def test_canonical_lines_are_the_same_for_any_partitions(spark, tmp_path):
    rows = [(k % 40, {"b": [k, None], "a": "é\n"}, None if k % 3 else f"x{k}") for k in range(200)] + [(1, {"b": [1, None], "a": "é\n"}, "twice")] * 2
    df = spark.createDataFrame(rows, "k int, v struct<b:array<int>,a:string>, t string")
    for n, name in ((1, "one"), (7, "two")):
        sinks.write_canonical(df.repartition(n), f"{tmp_path}/{name}", "k", 3)
    assert content(tmp_path / "one") == content(tmp_path / "two") and len(content(tmp_path / "one")) == 3
    lines = b"".join(content(tmp_path / "one")).decode().splitlines()
    want = [json.dumps({"k": k, "v": v, "t": t}, sort_keys=True, ensure_ascii=False) for k, v, t in rows]
    assert sorted(lines) == sorted(want)
    with pytest.raises(FileExistsError):
        sinks.write_canonical(df, f"{tmp_path}/one", "k")
    sinks.write_canonical(df.limit(0), f"{tmp_path}/one", "k", replace=True)
    assert content(tmp_path / "one") in ([], [b""])


def test_an_incomplete_write_is_not_published(spark, tmp_path):
    lines = spark.createDataFrame([("a",), ("b",), ("b",)], "value string")
    for other in (lines.limit(2), lines.union(lines), spark.createDataFrame([("a",), ("b",), ("c",)], "value string"), lines.distinct()):
        with pytest.raises(ValueError, match="nothing is published"):
            sinks.publish(lines, other, f"{tmp_path}/out", [])
    assert list(tmp_path.iterdir()) == []
    sinks.publish(lines, lines.orderBy(F.desc("value")), f"{tmp_path}/out", [])
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


EVENT = "ids array<string>, fiscal_years array<int>, type string, date string, description string, routine boolean, corroborating bigint, predates_window boolean"


def test_timeline_tables(spark, tmp_path):
    rows = [(["E2"], [2022], "other", "2022-05", "b | c", False, 1, False), (["E1", "E3"], [2022], "a_type", "2022-05", "a\nb", False, 2, False), (["E4"], [2021], None, "2019", "old", True, 1, True), (["E5"], [2022], "", None, "no date", True, 1, False), (["E5"], [2022], "", None, "no date", True, 1, False), (["E6"], [2021], "x", None, "earlier", False, 1, False)]
    events = spark.createDataFrame(rows, EVENT)
    for n, name in ((1, "one"), (5, "two")):
        sinks.write_timeline(events.repartition(n), f"{tmp_path}/{name}")
    assert content(tmp_path / "one") == content(tmp_path / "two")
    assert [t.decode().splitlines() for t in content(tmp_path / "one")] == [
        ["| 2022-05 | a type | a b (x2 filings) | E1, E3 |", "| 2022-05 | other | b \\| c | E2 |"],
        ["| 2019 | other | old (predates the window) | E4 |"],
        ["| FY2021 | x | earlier | E6 |", "| FY2022 | other | no date | E5 |", "| FY2022 | other | no date | E5 |"],
    ]


def test_glyphs(spark):
    said = "and the year was good for our board, that is with a final offer we made in the year and for all that the filings say. " * 3
    rng = random.Random(1)
    texts, want = [], []
    for k, offset in enumerate((0, -29, 3)):
        glyph = lambda c: f"(cid:{ord(c) - offset})"  # noqa: B023, E731
        texts.append((k, "".join(map(glyph, said)).replace(f"{glyph('f')}{glyph('i')}", "(cid:299)") + "\n"))
        want.append((said + "\n", offset, 0, True))
    texts += [(3, said), (4, "(cid:7)(cid:5)(cid:5)(cid:7)"), (5, None), (6, ""), (7, "".join(f"(cid:{rng.randrange(400, 900)})" for _ in range(50)) + "(cid:3)" * 40)]
    got = {r.doc: tuple(r)[1:] for r in glyphs.decoded(spark.createDataFrame(texts, "doc int, text string")).collect()}
    assert [got[k] for k in range(3)] == want
    assert got[3] == (said, None, 0, True) and got[4] == ('"  "', 27, 0, False)
    assert got[5] == (None, None, None, None) and got[6] == ("", None, 0, False)
    assert got[7][3] is False and got[7][2] == 50 and "�[cid:" in got[7][0]


def test_glyphs_read_at_once_are_those_of_the_pattern():
    rng = random.Random(5)
    bits = ["(cid:3)", "(cid:299)", "(cid:40)", "(cid:", "cid:3)", "((cid:7)", "(cid:)", "(cid:007)", "(cid:1234567)", "(cid:٣)", " ", "\n", "a", "(cid:12", "\x01", "(cid:9x)", "the "]
    plain = bits[:7] + bits[10:]
    for k in range(4000):
        raw = "".join(rng.choices(plain if k % 2 else bits, k=rng.randint(0, 12)))
        found = glyphs.occurrences(raw)
        if found is None:
            assert any(b in raw for b in bits[7:10])
        else:
            at, stop, ids = (x.tolist() for x in found)
            assert [(m.start(), m.end(), int(m[1])) for m in glyphs.GLYPH.finditer(raw)] == list(zip(at, stop, ids, strict=True))
            assert glyphs.joined(raw, *found[:2], ["_"] * len(at)) == glyphs.GLYPH.sub("_", raw)


def test_texts_spelled_in_glyphs(spark):
    rows = spark.createDataFrame([("ab\n~é", 600), (None, 600), ("a", None)], "text string, font long")
    assert [r[0] for r in rows.select(glyphs.in_glyphs("text", "font")).collect()] == ["(cid:697)(cid:698)\n(cid:726)é", None, None]


def test_batches_of_long_texts_are_small(spark):
    ship(spark)
    texts = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    rows_of_batch = F.pandas_udf(lambda t: pd.Series([len(t)] * len(t)), "long")
    assert texts.select(rows_of_batch("text").alias("n")).agg(F.max("n")).first()[0] * 100_000 <= BATCH_BYTES + 100_000
