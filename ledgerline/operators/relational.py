"""Relational operators of the evidence pipeline: cadence, as-of pairing, keyed upsert, rank-1 choice, audits, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Corrections are broadcast, so they may not be more.
MOST_FIXES = 10_000


def cadence_profile(df: DataFrame, key: str, day: str) -> DataFrame:
    """Rows, median gap in days, cadence label, first and last date of each key; repeats of a date count as gaps of 0."""
    gaps = df.withColumn("gap", F.datediff(day, F.lag(day).over(Window.partitionBy(key).orderBy(day))))
    out = gaps.groupBy(key).agg(F.count("*").alias("n_rows"), F.median("gap").alias("median_gap_days"), F.min(day).alias("first_date"), F.max(day).alias("last_date"))
    m = F.col("median_gap_days")
    label = F.when(m.isNull(), "single filing").when(m.between(21, 40), "~monthly").when(m.between(75, 105), "~quarterly").when(m.between(160, 200), "~semi-annual").when(m < 21, "clustered").otherwise("irregular")
    return out.withColumn("cadence", label)


def asof_forward(df: DataFrame, key: str, at: str, is_left: Column, is_right: Column, ident: str) -> DataFrame:
    """For each left row the first right row strictly after it and strictly before the next left row of the key.

    One sort per key, latest first, and a frame that only grows, so a key's work is linear after its sort; no join, so a hot key
    makes no product.
    """
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    marked = df.select(key, ident, micros.alias("t"), F.col(at).alias("at"), is_left.alias("l"), is_right.alias("r"))
    ahead = Window.partitionBy(key).orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, -1)  # grows row by row: later times come first
    nxt = marked.withColumn("bound", F.min(F.when(F.col("l"), F.col("t"))).over(ahead)).withColumn("found", F.min(F.when(F.col("r"), F.struct("t", ident))).over(ahead))
    ok = F.col("found").isNotNull() & (F.col("bound").isNull() | (F.col("found.t") < F.col("bound")))
    return nxt.where("l").select(key, F.col(ident).alias("left_id"), F.when(ok, F.col(f"found.{ident}")).alias("right_id"), F.when(~ok & F.col("found").isNull(), "no later row").when(~ok, "only after the next one").alias("gap_reason"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows and new rows, where the new one of a key wins; of several in one table, the greatest by its columns in order.

    A grouped maximum with map-side combination, so rows of a hot key are reduced before the exchange. Columns may have any type
    that can be compared. Null keys are one key.
    """
    run = "".join(old.columns) + "_run"  # no column has this name
    both = old.withColumn(run, F.lit(0)).unionByName(new.withColumn(run, F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max(F.struct(run, *rest)).alias(run))
    return best.select(*(F.col(c) if c in keys else F.col(run)[c].alias(c) for c in old.columns))


def choose_one(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Every row with its rank within its key by `order`, and whether it is the chosen one."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("choice_rank", rank.cast("bigint")).withColumn("chosen", F.col("choice_rank") == 1)


def flatten_parallel(df: DataFrame, key: str, arrays: list[str]) -> DataFrame:
    """One row for each position of parallel arrays; missing entries are null."""
    return df.select(key, F.posexplode(F.arrays_zip(*arrays)).alias("pos", "e")).select(key, F.col("pos").cast("bigint").alias("pos"), *(F.col(f"e.{a}").alias(a) for a in arrays))


def year_over_year(df: DataFrame, year: str, keys: list[str], value: str) -> DataFrame:
    """Each year's value beside the year's before; a missing baseline stays null and says why."""
    before = df.select((F.col(year) + 1).alias(year), *keys, F.col(value).alias("baseline"))
    joined = df.join(before, [year, *keys], "left")
    return joined.withColumn("delta", F.col(value) - F.col("baseline")).withColumn("unavailable_reason", F.when(F.col("baseline").isNull(), "no prior year"))


def carry_forward(df: DataFrame, key: str, order: list[str], value: Column, name: str) -> DataFrame:
    """The last non-null value so far in each key."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(*order)))


def island_ids(df: DataFrame, key: str, order: list[str], is_full: Column, name: str) -> DataFrame:
    """Number the groups that arise when a row that isn't full is merged into the next one (may chain)."""
    w = Window.partitionBy(key).orderBy(*order)
    ended = F.lag(is_full.cast("int")).over(w)
    return df.withColumn("_ended", F.coalesce(ended, F.lit(0))).withColumn(name, F.sum("_ended").over(w)).drop("_ended")


def apply_corrections(df: DataFrame, fixes: DataFrame, key: str, match: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Patched rows, and an audit with the number of rows each correction matched. `fixes`: key, expected, new_value.

    Two corrections of one key and expected value are an error, as either could win. The audit is for `exactly_once` before a write.
    Columns of `df` may have any names; a null expected value matches nothing.
    """
    few = fixes.select(F.col(key).alias("k"), F.col("expected").alias("e"), F.col("new_value").alias("v")).limit(MOST_FIXES + 1)
    if few.count() > MOST_FIXES:
        raise ValueError("corrections are a small table")
    if twice := few.groupBy("k", "e").count().where("count > 1").collect():
        raise ValueError(f"corrections given twice: {[(r['k'], r['e']) for r in twice]}")
    rows, fix = df.alias("rows"), F.broadcast(few).alias("fix")
    same = (F.col(f"rows.{key}") == F.col("fix.k")) & (F.col(f"rows.{match}") == F.col("fix.e"))
    hit = F.col("fix.k").isNotNull()
    patched = rows.join(fix, same, "left").select(*(F.when(hit, F.col("fix.v")).otherwise(F.col(f"rows.{c}")).alias(c) if c == value else F.col(f"rows.{c}") for c in df.columns), hit.alias("corrected"))
    met = rows.join(fix, same).select("fix.k", "fix.e").groupBy("k", "e").agg(F.count("*").alias("n"))
    audit = few.join(met, ["k", "e"], "left").groupBy(F.col("k").alias(key)).agg(F.sum(F.coalesce("n", F.lit(0))).cast("bigint").alias("n_matches"))
    return patched, audit


def exactly_once(audit: DataFrame) -> None:
    """Raise unless every correction has matched one row: before anything is written."""
    if wrong := audit.where("n_matches <> 1").limit(20).collect():  # an error message shows some
        raise ValueError(f"corrections that don't match one row: {[tuple(r) for r in wrong]}")


def multiset_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """How many more of each value the left has; by counts, so equal values meet in map-side partial sums."""
    both = left.select(F.col(column).alias("v"), F.lit(1).alias("d")).unionByName(right.select(F.col(column).alias("v"), F.lit(-1).alias("d")))
    return both.groupBy("v").agg(F.sum("d").alias("surplus")).where("surplus > 0").withColumnRenamed("v", column)


def budget_rung(df: DataFrame, key: str, length: Column, rungs: list[int], budget: int) -> DataFrame:
    """key, rung, fits: the largest excerpt length of the ladder whose total fits the budget, for each key; if none does, the shortest, which is flagged as not fitting."""
    ladder = F.explode(F.array(*(F.lit(r) for r in rungs))).alias("rung")
    sums = df.select(F.col(key).alias("key"), length.alias("len")).select("key", "len", ladder).groupBy("key", "rung").agg(F.sum(F.least("len", "rung")).alias("total"))
    best = sums.groupBy("key").agg(F.max(F.when(F.col("total") <= budget, F.col("rung"))).alias("best"))
    return best.select(F.col("key").alias(key), F.coalesce("best", F.lit(min(rungs))).alias("rung"), F.col("best").isNotNull().alias("fits"))


def components_by_block(edges: DataFrame, block: str, ident: str) -> DataFrame:
    """Where edges join all equal values of a block key, the component of each row is its block's smallest id."""
    return edges.groupBy(block).agg(F.min(ident).alias("component"), F.count("*").alias("members"))


def _range_of(key: Column, bounds: list[Column], low: int, high: int) -> Column:
    """How many of the sorted bounds are not above the key, by a tree of comparisons."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(key < bounds[mid], _range_of(key, bounds, low, mid)).otherwise(_range_of(key, bounds, mid + 1, high))


def positions(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """The row number of each row in its group by `order` (nulls first), for groups of any size.

    Rows are dealt to ranges of (group, order) whose bounds come from a sample, taken by hash and collected once, so
    every evaluation deals alike; a row's number is that in its range, plus the rows of its group in the ranges before.
    The sample only evens out the ranges. Rows that agree in group and order share a range.
    """
    keys = [group, *order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*keys).alias("key")
    sample = df.select(key).orderBy(F.xxhash64("key"), "key").limit(20 * n).orderBy("key").collect()
    kinds = [df.schema[k].dataType for k in keys]
    bounds = [F.struct(*(F.lit(v).cast(t).alias(k) for v, t, k in zip(r.key, kinds, keys, strict=True))) for r in sample[20::20]]
    dealt = df.withColumn("_key", F.struct(*keys)).withColumn("_range", _range_of(F.col("_key"), bounds, 0, len(bounds))).drop("_key")
    sizes = dealt.groupBy(group, "_range").agg(F.count("*").alias("_rows"))  # about one row for each range
    before = F.sum("_rows").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(F.col(group).alias("_group"), F.col("_range").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))
    placed = dealt.withColumn("_place", F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order)))
    joined = placed.join(F.broadcast(offsets), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return joined.withColumn(name, F.col("_before") + F.col("_place")).drop("_group", "_of", "_before", "_place", "_range")
