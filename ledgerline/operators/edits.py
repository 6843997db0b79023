"""Declared changes of written documents: corrections of their text, and citations whose fact got another id.

A correction says that the document was wrong: its `find` has to be there exactly once, in the text as the corrections before it left it. A remap says
that the id moved under a claim that didn't: the old id must be gone, the new one there, and both must say the same. Both are checked over
all documents before any text is handed on.

Defined cases: a document without edits keeps its text; a null text has no occurrence of anything; an empty `find` is an error; edits of documents that aren't there are errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.checks import KNOWN_ID


def times(text: Column, find: Column) -> Column:
    """How often a text holds another, without overlaps; null for an empty one."""
    return ((F.length(text) - F.length(F.replace(text, find, F.lit("")))) / F.nullif(F.length(find), F.lit(0))).cast("int")


def corrected(docs: DataFrame, corrections: DataFrame) -> DataFrame:
    """doc, text, records (id, was, now), problems (id, n) of every document after its corrections in order.

    `docs`: doc, text. `corrections`: doc, seq, id, find, replace. One that isn't found exactly once changes nothing and is a problem.
    """
    edits = corrections.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("seq", "id", "find", "replace"))).alias("edits"))
    kept, missed = "array<struct<id:string,was:string,now:string>>", "array<struct<id:string,n:int>>"
    row = lambda text, records, problems: F.struct(text.alias("text"), records.alias("records"), problems.alias("problems"))

    def step(acc: Column, e: Column) -> Column:
        n = F.coalesce(times(acc["text"], e["find"]), F.lit(0))
        done = row(F.replace(acc["text"], e["find"], e["replace"]), F.array_append(acc["records"], F.struct(e["id"].cast("string").alias("id"), e["find"].alias("was"), e["replace"].alias("now"))), acc["problems"])
        return F.when(n == 1, done).otherwise(row(acc["text"], acc["records"], F.array_append(acc["problems"], F.struct(e["id"].cast("string").alias("id"), n.alias("n")))))

    start = row(F.col("text"), F.array().cast(kept), F.array().cast(missed))
    joined = docs.select("doc", "text", F.lit(True).alias("here")).join(edits, "doc", "full")
    folded = joined.withColumn("r", F.aggregate(F.coalesce("edits", F.array().cast(corrections.select(F.array(F.struct("seq", "id", "find", "replace"))).schema[0].dataType)), start, step))
    return folded.select("doc", "r.text", "r.records", F.when(F.col("here"), F.col("r.problems")).otherwise(F.transform("edits", lambda e: F.struct(e["id"].cast("string").alias("id"), F.lit(0).alias("n")))).alias("problems"))


def remap_problems(remaps: DataFrame, index: DataFrame, claims: DataFrame) -> DataFrame:
    """was, now, problem of every remap that can't be used. `remaps`: was, now. `index`: id. `claims`: id, claim (canonical) of every fact ever written."""
    known = index.select("id").distinct()
    has = lambda c, name: known.select(F.col("id").alias(c), F.lit(True).alias(name))
    says = lambda c, name: claims.select(F.col("id").alias(c), F.col("claim").alias(name)).dropDuplicates([c])
    seen = remaps.select("was", "now").join(has("was", "old"), "was", "left").join(has("now", "new"), "now", "left").join(says("was", "said"), "was", "left").join(says("now", "says"), "now", "left")
    problem = F.when(F.col("old"), "the old id is still there").when(F.col("new").isNull(), "the new id is not there").when(F.col("said").isNotNull() & ~F.col("said").eqNullSafe(F.col("says")), "they say different things")
    return seen.select("was", "now", problem.alias("problem")).where("problem is not null")


def remapped(docs: DataFrame, remaps: DataFrame) -> DataFrame:
    """doc, text, remaps (was, now, n) of every document with its citations of old ids rewritten; only the ids that a document cites are looked at."""
    cited = docs.select("doc", F.explode(F.regexp_extract_all("text", F.lit(KNOWN_ID), F.lit(0))).alias("was")).groupBy("doc", "was").agg(F.count("*").cast("int").alias("n"))
    own = cited.join(remaps.select("was", "now").dropDuplicates(["was"]), "was").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("was", "now", "n"))).alias("remaps"))
    text = F.aggregate(F.coalesce("remaps", F.array().cast("array<struct<was:string,now:string,n:int>>")), F.col("text"), lambda t, r: F.regexp_replace(t, F.concat(F.lit(r"\b"), r["was"], F.lit(r"\b")), r["now"]))
    return docs.select("doc", "text").join(own, "doc", "left").select("doc", text.alias("text"), F.coalesce("remaps", F.array().cast("array<struct<was:string,now:string,n:int>>")).alias("remaps"))


def usable(corrections: DataFrame, remaps: DataFrame) -> None:
    """Raise unless every correction was found exactly once and every remap holds: before anything is written."""
    wrong = [f"{r['doc']}: {p['id']} found {p['n']} times" for r in corrections.where("size(problems) > 0").select("doc", "problems").limit(20).collect() for p in r["problems"]]
    wrong += [f"{r['was']} -> {r['now']}: {r['problem']}" for r in remaps.limit(20).collect()]  # an error message shows some
    if wrong:
        raise ValueError("nothing is written: " + "; ".join(wrong))
