"""A company's filings from a cached index: a main block of the newest ones, and shards of older ones with the dates they span.

Only the shards that reach back to the day asked for are opened: the main block lists their dates, so that is known before any is read. Every row says as of
when its file was true: as recorded when it was fetched, else by the file's time. All files are read by Spark, from any store.

Files in a folder: `<name>.json` with filings.recent (parallel arrays) and filings.files (name, filingFrom, filingTo), `<name>_<shard>`
for each shard (parallel arrays), and `fetch-log.json`, an object of file names and times.

Defined cases: a missing array gives "" and a missing report date null; a broken or missing file that is needed is an error, one that isn't needed is never
opened; without a log the file's time counts; an index without filings gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The parallel arrays of a block, and the columns they become. Fixed names.
ARRAYS = {"accessionNumber": "accession", "form": "form", "filingDate": "filing_date", "reportDate": "report_date", "items": "items", "primaryDocument": "primary_doc", "primaryDocDescription": "description"}
BLOCK = f"struct<{', '.join(f'{name}:array<string>' for name in ARRAYS)}>"
INDEX = f"filings struct<recent:{BLOCK}, files:array<struct<name:string, filingFrom:string, filingTo:string>>>"
RECORDED, BY_FILE = "recorded when fetched", "file time, inferred"
LOG = "fetch-log.json"


def loud(json: Column, schema: str) -> Column:
    """JSON text as a struct; anything else is an error."""
    return F.from_json(json, schema, {"mode": "FAILFAST"})


def flattened(df: DataFrame, block: Column) -> DataFrame:
    """A row for each place of a block's parallel arrays; the accessions say how many there are."""
    n = F.size(F.coalesce(block["accessionNumber"], F.array().cast("array<string>")))
    at = lambda name: lambda i: F.coalesce(F.get(block[name], i), F.lit(""))
    rows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(*(at(name)(i).alias(column) for name, column in ARRAYS.items())))
    flat = df.withColumn("r", F.explode(F.when(n > 0, rows))).select(*df.columns, "r.*")
    day = lambda c: F.to_date(F.nullif(F.col(c), F.lit("")))
    return flat.withColumns({"form": F.trim("form"), "filing_date": day("filing_date"), "report_date": day("report_date")})


def read_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, changed, json of whole files."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("changed"), F.col("value").alias("json"))


def needed(newest_from: str | None, files: list[tuple[str, str, str]], back_to: str) -> list[str]:
    """The shards (name, from, to, newest first) that are read for all filings from `back_to` on: up to the first that reaches behind it."""
    earliest, out = newest_from, []
    for name, first, last in files:
        if earliest is not None and earliest <= back_to:
            break
        if earliest is not None and first > earliest:
            continue
        out.append(name)
        earliest = first if earliest is None else min(earliest, first)
        if last < back_to:
            break
    return out


def read_filings(spark: SparkSession, folder: str, name: str, back_to: str) -> DataFrame:
    """accession, form, filing_date, report_date, items, primary_doc, description, file, as_of, as_of_basis of a company's filings, back to `back_to` (YYYY-MM-DD) or more."""
    folder = folder.rstrip("/")
    main = read_text(spark, [f"{folder}/{name}.json"])
    block = main.withColumn("index", loud(F.col("json"), INDEX))
    head = block.select(F.array_min(F.filter("index.filings.recent.filingDate", lambda d: d != "")).alias("first"), "index.filings.files").first()  # one row: the company's
    shards = needed(head["first"], [(f["name"], f["filingFrom"], f["filingTo"]) for f in head["files"] or []], back_to)
    rows = flattened(block.select("file", "changed", F.col("index.filings.recent").alias("block")), F.col("block")).drop("block")
    if shards:
        parts = read_text(spark, [f"{folder}/{name}_{s}" for s in shards]).withColumn("block", loud(F.col("json"), BLOCK)).drop("json")
        rows = rows.unionByName(flattened(parts, F.col("block")).drop("block"))
    return vintage(rows, recorded(spark, folder))


def recorded(spark: SparkSession, folder: str) -> DataFrame:
    """file, as_of of the log; without one, or with a broken one, no rows."""
    try:
        log = spark.read.text(f"{folder}/{LOG}", wholetext=True)
    except Exception as e:  # noqa: BLE001  a missing log is a defined case
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "file string, as_of string")
    return log.select(F.explode(F.from_json("value", "map<string,string>")).alias("file", "as_of"))


def vintage(rows: DataFrame, log: DataFrame) -> DataFrame:
    """`rows` (file, changed) with as_of and its basis: it belongs to the data, not to the run."""
    own = rows.join(log, "file", "left")
    inferred = F.date_format(F.to_utc_timestamp("changed", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return own.withColumn("as_of_basis", F.when(F.col("as_of").isNotNull(), RECORDED).otherwise(BY_FILE)).withColumn("as_of", F.coalesce("as_of", inferred)).drop("changed")
