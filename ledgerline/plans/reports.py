"""Registered queries of sections, matched lists and calendar reports, over nodes and filings made from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.register import register
from ledgerline.operators import fiscal, outcomes, sections
from ledgerline.plans.catalogue import FY, long, orders, query
from ledgerline.sources.tables import table

FLOOR = 200
_SPANS = """
WITH n AS (SELECT conv_id, turn, CASE WHEN role = 'user' AND turn % 7 <> 3 THEN CAST(turn % 3 + 1 AS VARCHAR) || 'A' END AS item, CASE WHEN role = 'user' THEN 8 WHEN text = '' THEN 1 ELSE length(text) END AS len FROM conversations),
s AS (SELECT *, count(item) OVER (PARTITION BY conv_id ORDER BY turn) AS span FROM n),
g AS (SELECT conv_id, max(item) AS item, min(turn) AS start_ord, max(turn) AS end_ord, CAST(coalesce(sum(len), 0) AS BIGINT) AS n_chars FROM s WHERE span > 0 GROUP BY conv_id, span)
"""


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """Turns as text nodes: those of users are headings of eight characters, some of them in links."""
    t = table(spark, d, "conversations")
    said = F.when(F.col("role") == "user", F.format_string("Item %da.", F.col("turn") % 3 + 1)).otherwise(F.concat(F.lit("-"), F.substring("text", 2, 1 << 30)))
    rows = t.select("conv_id", "turn", said.alias("said"), (F.col("turn") % 7 == 3).alias("in_link"))
    return sections.headings(rows, "said", "in_link", r"^Item (\d[aA])\.", 20)


@query(_SPANS + "SELECT conv_id, item, start_ord, end_ord, n_chars FROM g")
def section_spans(spark: SparkSession, d: str) -> DataFrame:
    """The span of each heading of a conversation, up to the next."""
    return sections.spans(nodes(spark, d), "conv_id", "turn", "said")


@query(_SPANS + f""", r AS (SELECT *, count(*) OVER (PARTITION BY conv_id, item) AS n_candidates, row_number() OVER (PARTITION BY conv_id, item ORDER BY n_chars < {FLOOR}, CASE WHEN n_chars >= {FLOOR} THEN start_ord END, n_chars DESC, start_ord) AS k FROM g)
SELECT conv_id, item, n_candidates, start_ord, end_ord, n_chars, CASE WHEN n_chars >= {FLOOR} THEN 'first over the floor' ELSE 'largest' END AS basis FROM r WHERE k = 1""")
def section_choice(spark: SparkSession, d: str) -> DataFrame:
    """One span for each conversation and item: the first over the floor, else the largest."""
    return sections.chosen_span(section_spans(spark, d), "conv_id", FLOOR)


@query("""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, doc_id % 4 = 0 AS whole FROM documents), c AS (SELECT *, lower(x) AS l, length(x) AS n, len(regexp_extract_all(regexp_replace(x, '[^ \\t\\n]+\\.(jpg|jpeg|png|gif)', ' ', 'g'), '[A-Za-z]{2,}')) AS w FROM t),
a AS (SELECT *, CAST(contains(l, 'the') AS INT) + CAST(contains(l, 'licen') AS INT) + CAST(contains(l, 'of') AS INT) AS k, len(regexp_extract_all(x, '(?i)\\btoken\\b')) AS o1, len(regexp_extract_all(x, '(?i)the\\s+and')) AS o2 FROM c)
SELECT doc_id, concat_ws('; ', CASE WHEN n < CASE WHEN whole THEN 120 ELSE 500 END THEN 'characters: ' || n END, CASE WHEN w < 25 THEN 'words: ' || w END, CASE WHEN NOT whole AND n < 800 THEN 'shorter than expected: ' || n END, CASE WHEN NOT whole AND n > 6000 THEN 'longer than expected: ' || n END,
  CASE WHEN k < 2 THEN 'anchors: ' || k END,
  CASE WHEN NOT whole AND ((o1 > 0 AND o2 > 0) OR o1 >= 3 OR o2 >= 3) THEN 'overrun: ' || concat_ws(', ', CASE WHEN o1 > 0 THEN '\\btoken\\b x' || o1 END, CASE WHEN o2 > 0 THEN 'the\\s+and x' || o2 END) END) AS problems FROM a""")
def section_validation(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with each document, were it a section; every fourth is a whole document."""
    found = sections.section_problems(F.col("text"), 500, 25, ["the", "licen", "of"], 2, [r"\btoken\b", r"the\s+and"], (800, 6000), F.col("doc_id") % 4 == 0)
    return table(spark, d, "documents").select("doc_id", F.array_join(found, "; ").alias("problems"))


_LISTS = "WITH c AS (SELECT p_brand, p_partkey FROM part WHERE p_partkey % 2 = 1), p AS (SELECT p_brand, p_partkey FROM part WHERE p_partkey % 2 = 0), m AS (SELECT c.p_brand, c.p_partkey AS l, p.p_partkey AS r, c.p_partkey % 50 + 50 AS s, p.p_partkey % 37 + 60 AS b FROM c JOIN p ON p.p_brand = c.p_brand AND p.p_partkey = c.p_partkey + 1)"


def lists(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts with odd keys as the current list of their brand, with even keys as the prior one; a part and its successor are a pair."""
    p = table(spark, d, "part").select("p_brand", F.col("p_partkey").alias("ord"))
    now, prior = p.where("ord % 2 = 1"), p.where("ord % 2 = 0")
    pairs = now.select("p_brand", F.col("ord").alias("left_ord"), (F.col("ord") + 1).alias("right_ord")).join(prior.withColumnRenamed("ord", "right_ord"), ["p_brand", "right_ord"])
    return now, prior, pairs.select("p_brand", "left_ord", "right_ord", (F.col("left_ord") % 50 + 50).alias("score"), (F.col("right_ord") % 37 + 60).alias("body_score"))


@query(_LISTS + """
SELECT coalesce(c.p_brand, p.p_brand) AS p_brand, c.p_partkey AS left_ord, p.p_partkey AS right_ord, CASE WHEN p.p_partkey IS NULL THEN 'added' WHEN c.p_partkey IS NULL THEN 'removed' WHEN s >= 95 AND b >= 90 THEN 'unchanged' ELSE 'reworded' END AS outcome,
  CASE WHEN s >= 95 AND b < 90 THEN 'body only' WHEN s < 95 AND b >= 90 THEN 'heading only' WHEN s < 95 AND b < 90 THEN 'heading and body' END AS changed
FROM c LEFT JOIN m ON m.l = c.p_partkey FULL JOIN p ON p.p_partkey = m.r""")
def match_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Which parts of a brand were unchanged, reworded, added or removed, by given scores."""
    return outcomes.match_outcome(*lists(spark, d), "p_brand", 95, 90)


@query()
def list_diff(spark: SparkSession, d: str) -> DataFrame:
    """Parts with odd keys against those with even keys among each twenty: unchanged, reworded, added, removed, by their own names and makers."""
    p = table(spark, d, "part").select(F.floor(F.col("p_partkey") / 20).alias("block"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("heading"), F.concat_ws(" ", "p_name", "p_brand").alias("body"))
    return outcomes.list_diff(p.where("ord % 2 = 1"), p.where("ord % 2 = 0"), "block")


@query(_LISTS + """, n AS (SELECT c.p_brand, count(*) AS n_now, count(m.l) AS matched FROM c LEFT JOIN m ON m.l = c.p_partkey GROUP BY 1)
SELECT p_brand, CASE WHEN matched = 0 THEN 'nothing matched' ELSE 'little matched' END AS problem FROM n WHERE matched < 0.4 * n_now""")
def outcome_problems(spark: SparkSession, d: str) -> DataFrame:
    """Brands of which too little is matched to rely on the outcome."""
    now, prior, pairs = lists(spark, d)
    return outcomes.outcome_problems(outcomes.match_outcome(now, prior, pairs, "p_brand", 95, 90), now, prior, "p_brand")


@query("SELECT i AS year FROM range(1990, 2006) t(i) WHERE i NOT IN (SELECT year(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderpriority = '1-URGENT')")
def years_without(spark: SparkSession, d: str) -> DataFrame:
    """Years from 1990 to 2005 without an urgent order."""
    return outcomes.missing_years(orders(spark, d).where("o_orderpriority = '1-URGENT'").select(F.year("od").alias("year")), "year", 1990, 2005)


@query(f"SELECT o_custkey, CAST({FY} AS BIGINT) AS fiscal_year, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) <> 4")
def off_rhythm(spark: SparkSession, d: str) -> DataFrame:
    """Customers' fiscal years that have orders, but not four."""
    filings = orders(spark, d).select(F.struct("o_custkey", long(fiscal.containing(F.col("od"), 6, 30)).alias("fiscal_year")).alias("year"))
    return outcomes.off_rhythm(filings, "year", 4).select("year.*", "n")


@query("SELECT * FROM (SELECT o_orderkey, date_diff('day', make_date(year(CAST(o_orderdate AS DATE)), 6, 30), CAST(o_orderdate AS DATE)) AS drift FROM orders) WHERE abs(drift) > 7")
def year_end_drift(spark: SparkSession, d: str) -> DataFrame:
    """Orders more than a week from 30 June of their year."""
    return outcomes.year_end_drift(orders(spark, d), "od", 6, 30).select("o_orderkey", "drift")


@query("SELECT p_type AS form, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_type) AS place FROM part WHERE p_size > 25 GROUP BY 1")
def scope_counts(spark: SparkSession, d: str) -> DataFrame:
    """Types of large parts, the most frequent first; types are few, so one task places them."""
    counts = table(spark, d, "part").where("p_size > 25").groupBy(F.col("p_type").alias("form")).agg(F.count("*").alias("n"))
    return counts.withColumn("place", long(F.row_number().over(Window.orderBy(F.desc("n"), "form"))))


@query()
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """Each benchmark text against itself in capitals, by the functions registered for SQL."""
    register(spark)
    table(spark, d, "benchmark").createOrReplaceTempView("ledgerline_items")
    return spark.sql("SELECT item_id, canon_text(text) AS canon, token_sort_ratio(text, upper(text)) AS sorted, token_set_ratio(text, upper(text)) AS as_sets, verify_quote(text, text) AS verified FROM ledgerline_items")
