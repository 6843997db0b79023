"""What became of matched lists, and reports of what a filing calendar lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import token_sort_ratio
from ledgerline.operators.matching import greedy_match
from ledgerline.sources.shipping import ship


def match_outcome(current: DataFrame, prior: DataFrame, pairs: DataFrame, block: str, same_at: float, body_at: float) -> DataFrame:
    """(block, left_ord, right_ord, outcome, changed) of every row of both lists: a full outer join by way of the pairs.

    `current` and `prior` have block and ord; `pairs` block, left_ord, right_ord, score (of the headings) and body_score. A pair is
    unchanged if both scores reach their bounds, else reworded, and `changed` says in what; what is in no pair was added or removed.
    A pair without a score counts as changed there.
    """
    same, body = F.coalesce(F.col("score") >= same_at, F.lit(False)), F.coalesce(F.col("body_score") >= body_at, F.lit(False))
    moved = F.when(same & ~body, "body only").when(~same & body, "heading only").when(~same & ~body, "heading and body")
    now = current.select(block, F.col("ord").alias("left_ord")).join(pairs, [block, "left_ord"], "left")
    kind = F.when(F.col("right_ord").isNull(), "added").when(same & body, "unchanged").otherwise("reworded")
    seen = now.select(block, "left_ord", "right_ord", kind.alias("outcome"), F.when(F.col("right_ord").isNotNull(), moved).alias("changed"))
    gone = prior.select(block, F.col("ord").alias("right_ord")).join(pairs.select(block, "right_ord"), [block, "right_ord"], "left_anti")
    none = F.lit(None)
    return seen.unionByName(gone.select(block, none.cast(now.schema["left_ord"].dataType).alias("left_ord"), "right_ord", F.lit("removed").alias("outcome"), none.cast("string").alias("changed")))


def list_diff(current: DataFrame, prior: DataFrame, block: str, same_at: float = 95, body_at: float = 90, floor: float = 60) -> DataFrame:
    """`match_outcome` of two lists (block, ord, heading, body) with heading_score and body_score: headings are matched one to one, best first, and
    the bodies of a pair are compared."""
    ship(current.sparkSession)
    pairs = greedy_match(current, prior, block, "ord", "heading", floor)
    said = lambda df, side: df.select(block, F.col("ord").cast("bigint").alias(f"{side}_ord"), F.coalesce("body", F.lit("")).alias(f"{side}_body"))
    both = pairs.join(said(current, "left"), [block, "left_ord"]).join(said(prior, "right"), [block, "right_ord"])
    scored = both.select(block, "left_ord", "right_ord", "score", token_sort_ratio("left_body", "right_body").alias("body_score"))
    out = match_outcome(current.withColumn("ord", F.col("ord").cast("bigint")), prior.withColumn("ord", F.col("ord").cast("bigint")), scored, block, same_at, body_at)
    shown = scored.select(block, "left_ord", F.round("score", 1).alias("heading_score"), F.round("body_score", 1).alias("body_score"))
    return out.join(shown, [block, "left_ord"], "left")


def category_counts(diffs: DataFrame, by: str) -> DataFrame:
    """`by`, unchanged, reworded, added, removed: how many rows of each outcome."""
    return diffs.groupBy(by).agg(*(F.count_if(F.col("outcome") == kind).alias(kind) for kind in ("unchanged", "reworded", "added", "removed")))


def outcome_problems(outcome: DataFrame, current: DataFrame, prior: DataFrame, block: str, least_share: float = 0.4) -> DataFrame:
    """(block, problem): blocks where nothing or too little of the current list is matched, or whose counts don't add up."""
    tally = outcome.groupBy(block).agg(*(F.count_if(F.col("outcome").isin(*kinds)).alias(name) for name, kinds in {"matched": ("unchanged", "reworded"), "added": ("added",), "removed": ("removed",)}.items()))
    sizes = current.groupBy(block).agg(F.count("*").alias("n_now")).join(prior.groupBy(block).agg(F.count("*").alias("n_prior")), block, "full_outer")
    all_ = sizes.join(tally, block, "full_outer").na.fill(0, ["n_now", "n_prior", "matched", "added", "removed"])
    some = F.col("n_now") > 0
    problems = F.array_compact(F.array(
        F.when(some & (F.col("matched") == 0), "nothing matched"),
        F.when(some & (F.col("matched") > 0) & (F.col("matched") < least_share * F.col("n_now")), "little matched"),
        F.when(F.expr("matched + added <> n_now"), "current list does not add up"),
        F.when(F.expr("matched + removed <> n_prior"), "prior list does not add up"),
    ))
    return all_.select(block, F.explode(problems).alias("problem"))


def missing_years(filings: DataFrame, year: str, first: int, last: int) -> DataFrame:
    """The years from first to last without a filing."""
    years = filings.sparkSession.range(first, last + 1).select(F.col("id").alias(year))
    return years.join(filings.select(F.col(year).cast("bigint").alias(year)).distinct(), year, "left_anti")


def off_rhythm(filings: DataFrame, year: str, expected: int) -> DataFrame:
    """(year, n) of the years that have filings, but not as many as expected."""
    return filings.groupBy(year).agg(F.count("*").alias("n")).where(F.col("n") != expected)


def year_end_drift(filings: DataFrame, report: str, month: int, day: int, most: int = 7) -> DataFrame:
    """Filings whose period ends more than `most` days from the year end of the same calendar year, with `drift` in days. `report` is a date; null has none."""
    end = F.least(F.make_date(F.year(report), F.lit(month), F.lit(1)) + F.lit(day - 1), F.last_day(F.make_date(F.year(report), F.lit(month), F.lit(1))))
    return filings.withColumn("drift", F.datediff(F.col(report), end).cast("bigint")).where(F.abs("drift") > most)


def the_one(df: DataFrame, column: str, value: str) -> DataFrame:
    """The row whose column is `value`, whatever the case; raises if there is none or more than one."""
    hits = df.where(F.upper(column) == value.upper())
    rows = hits.limit(2).collect()  # two prove that it is ambiguous
    if len(rows) != 1:
        raise LookupError(f"{value!r} is {'ambiguous' if rows else 'absent'} in {column}")
    return hits
