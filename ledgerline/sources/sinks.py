"""Sinks that write the same bytes whatever the partitions, and only what is complete.

Rows become lines; they are dealt to a fixed number of files by their key, or to ranges by their order, and sorted within. A write goes to a folder beside the
target, is read back, and is compared with what should be there, as a multiset; only then is it renamed to the target. What fails is deleted.

Defined cases: equal rows are each written; an empty table gives a folder without lines; a target that exists is an error unless it may be replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.values import canonical_value

#: Lines of a timeline file, about.
LINES = 1_000_000


def _folder(df: DataFrame, path: str):  # noqa: ANN202  a path and its file system in the JVM
    where = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())


def multiset(lines: DataFrame, column: str = "value") -> tuple[int, int]:
    """Number of lines and the sum of their hashes: equal for equal multisets, and for others as good as never."""
    r = lines.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(column).cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return r["n"], int(r["h"])


def publish(lines: DataFrame, wanted: DataFrame, path: str, parts: list[str], replace: bool = False) -> None:
    """Write `lines` (value, and the folders `parts`) as text to `path`, if what is then there is what `wanted` (value) has."""
    target, fs = _folder(lines, path)
    if fs.exists(target) and not replace:
        raise FileExistsError(path)
    staged, _ = _folder(lines, f"{path.rstrip('/')}._staged_{uuid.uuid4().hex}")
    try:
        lines.write.partitionBy(*parts).text(str(staged)) if parts else lines.write.text(str(staged))
        there, want = multiset(lines.sparkSession.read.text(str(staged), recursiveFileLookup=True)), multiset(wanted)
        if there != want:
            raise ValueError(f"{there[0]} lines were written of {want[0]}, or others: nothing is published")
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(staged, target):
            raise OSError(f"{path} could not be put in place")
    finally:
        if fs.exists(staged):
            fs.delete(staged, True)


def canonical_lines(df: DataFrame) -> DataFrame:
    """value: each row as JSON with sorted keys at every level."""
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    return df.select(canonical_value(row).alias("value"))


def write_canonical(df: DataFrame, path: str, key: str, n_files: int = 1, replace: bool = False) -> None:
    """Rows as canonical JSON lines in `n_files` files by a hash of the key, sorted within: byte for byte the same for any order and partitions of `df`."""
    keyed = df.select(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n_files)).alias("file"), F.col(key).cast("string").alias("k"), canonical_value(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})).alias("value"))
    dealt = keyed.repartition(n_files, "file").sortWithinPartitions("file", "k", "value").select("file", "value")
    publish(dealt, canonical_lines(df), path, ["file"], replace)


def cell(text: Column) -> Column:
    """A text inside a table: no line breaks, bars escaped."""
    return F.replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), F.lit("|"), F.lit("\\|"))


def timeline_lines(events: DataFrame) -> DataFrame:
    """section, first, second, value of merged events: a row of one of three tables (dated and material, dated and routine, without a date) and its place there."""
    section = F.when(F.col("date").isNull(), "3 undated").when(F.col("routine"), "2 routine").otherwise("1 material")
    year = F.lpad(F.coalesce(F.get("fiscal_years", F.lit(0)), F.lit(0)).cast("string"), 4, "0")
    note = F.concat(F.when(F.col("corroborating") > 1, F.concat(F.lit(" (x"), F.col("corroborating"), F.lit(" filings)"))).otherwise(""), F.when(F.col("predates_window"), " (predates the window)").otherwise(""))
    cells = [F.coalesce("date", F.concat(F.lit("FY"), year)), F.translate(F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit("other")), "_", " "), F.concat(cell(F.col("description")), note), F.concat_ws(", ", "ids")]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    return events.select(section.alias("section"), F.coalesce("date", year).alias("first"), F.coalesce("description", F.lit("")).alias("second"), line.alias("value"))


def write_timeline(events: DataFrame, path: str, replace: bool = False) -> None:
    """The three tables of a timeline, in order. Refused unless every event stands in one of them once."""
    lines = timeline_lines(events)
    n = max(1, -(-lines.count() // LINES))
    order = ["section", "first", "second", "value"]
    publish(lines.repartitionByRange(n, *order).sortWithinPartitions(*order).select("section", "value"), lines.select("value"), path, ["section"], replace)
