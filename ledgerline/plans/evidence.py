"""Registered queries of the ledger derivations, quotation and citation checks, over facts and documents made from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import quotes
from ledgerline.operators import checks, ledger
from ledgerline.plans.catalogue import FY, orders, query
from ledgerline.sources.shipping import ship
from ledgerline.sources.tables import table

FORMS = ["10-K", "10-Q", "DEF 14A", "ARS", "8-K/A", "10-K/A"]


def pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


@query(f"""
WITH o AS (SELECT o_orderkey, o_orderdate, CAST(o_orderdate AS DATE) AS d, regexp_replace(['10-K', '10-Q', 'DEF 14A', 'ARS', '8-K/A', '10-K/A'][o_orderkey % 6 + 1], '/A$', '') AS form, o_orderkey % 7 <> 0 AS has FROM orders),
f AS (SELECT *, CASE WHEN has THEN CASE WHEN abs(date_diff('day', make_date(year(d), 6, 30), d)) <= 10 THEN year(d) END END AS verified, {FY} AS holding FROM o)
SELECT o_orderkey, CAST(CASE WHEN form IN ('10-K', '10-Q') THEN coalesce(verified, CASE WHEN has THEN year(d) END, holding) WHEN form = 'ARS' THEN coalesce(verified, holding - 1) WHEN form = 'DEF 14A' THEN holding - 1 ELSE holding END AS BIGINT) AS fiscal_year,
  CASE WHEN form IN ('10-K', '10-Q') THEN CASE WHEN verified IS NOT NULL THEN 'reportDate (verified period end)' WHEN has THEN 'reportDate.year (period end is OFF-CYCLE — check)' ELSE 'filingDate (no reportDate)' END
    WHEN form = 'ARS' AND verified IS NOT NULL THEN 'reportDate (verified period end)' WHEN form IN ('ARS', 'DEF 14A') THEN 'most recently completed FY at filing' ELSE 'fiscal year containing filingDate' END AS basis FROM f""")
def fiscal_basis(spark: SparkSession, d: str) -> DataFrame:
    """Each order as a filing on its day, whose period of report is that day too or missing: its fiscal year and the basis."""
    report = F.when(F.col("o_orderkey") % 7 != 0, F.col("od"))
    got = ledger.fiscal_year_of(pick(FORMS, F.col("o_orderkey")), report, F.col("od"), 6, 30)
    return orders(spark, d).select("o_orderkey", got.alias("g")).select("o_orderkey", "g.*")


@query("""
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '0630' WHEN 1 THEN '' WHEN 2 THEN '630' WHEN 3 THEN NULL ELSE '1231 ' END AS raw FROM orders)
SELECT o_orderkey, CASE WHEN raw = '0630' THEN 6 ELSE 12 END AS month, CASE WHEN raw = '0630' THEN 30 ELSE 31 END AS day FROM r""")
def year_end_parse(spark: SparkSession, d: str) -> DataFrame:
    raw = F.element_at(F.array(F.lit("0630"), F.lit(""), F.lit("630"), F.lit(None).cast("string"), F.lit("1231 ")), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", ledger.year_end_of(raw).alias("e")).select("o_orderkey", "e.*")


SCOPE = {"8-K": {"include": ["5.02"], "date_only": ["2.02"], "triage": ["7.01", "8.01"]}, "10-K": {}, "10-Q": {}}


@query("""
WITH e AS (SELECT event_id, ['8-K', '10-K', 'NT 10-K', 'SC 13G', '8-K/A', '10-K/A'][event_id % 6 + 1] AS form, CASE event_id % 5 WHEN 0 THEN ['5.02', '9.01'] WHEN 1 THEN ['2.02', '7.01'] WHEN 2 THEN ['7.01'] WHEN 3 THEN [] ELSE ['9.01'] END AS items FROM events)
SELECT event_id, CASE WHEN form = 'NT 10-K' THEN 'gap_signal' WHEN form = 'SC 13G' THEN 'out_of_scope' WHEN form = '10-K/A' THEN 'out_of_scope' WHEN form = '10-K' THEN 'in_scope' WHEN len(items) = 0 THEN 'out_of_scope'
  WHEN list_contains(items, '5.02') THEN 'in_scope' WHEN list_contains(items, '2.02') THEN 'date_only' WHEN list_contains(items, '7.01') THEN 'triage' ELSE 'out_of_scope' END AS disposition FROM e""")
def filing_disposition(spark: SparkSession, d: str) -> DataFrame:
    """Events as filings, whose disposition follows from form and items by precedence."""
    items = F.when(F.col("event_id") % 5 == 0, F.array(F.lit("5.02"), F.lit("9.01"))).when(F.col("event_id") % 5 == 1, F.array(F.lit("2.02"), F.lit("7.01"))).when(F.col("event_id") % 5 == 2, F.array(F.lit("7.01"))).when(F.col("event_id") % 5 == 3, F.array().cast("array<string>")).otherwise(F.array(F.lit("9.01")))
    form = pick(["8-K", "10-K", "NT 10-K", "SC 13G", "8-K/A", "10-K/A"], F.col("event_id"))
    return table(spark, d, "events").select("event_id", ledger.disposition(form, items, ["NT 10-K"], SCOPE, ["8-K"])["disposition"].alias("disposition"))


@query("""
SELECT p_partkey, 'SEG-FY2021-' || substr(sha256('{"accession": "a-' || p_partkey || '", "field": "segments", "fiscal_year": 2021, "form": "10-K", "quote": "say \\"' || p_name || '\\"\\n", "section_key": null, "value": {"brand": "' || p_brand || '", "name": "' || p_name || '"}}'), 1, 8) AS fact_id FROM part""")
def fact_ids(spark: SparkSession, d: str) -> DataFrame:
    """The id of each part as a fact: a hash over the canonical JSON of what it says and where."""
    value = F.create_map(F.lit("name"), F.col("p_name"), F.lit("brand"), F.col("p_brand"))
    quote = F.concat(F.lit('say "'), F.col("p_name"), F.lit('"\n'))
    got = ledger.fact_id(F.lit("SEG"), F.lit(2021), F.lit("segments"), value, F.lit("10-K"), F.concat(F.lit("a-"), F.col("p_partkey").cast("string")), F.lit(None).cast("string"), quote)
    return table(spark, d, "part").select("p_partkey", got.alias("fact_id"))


@query("SELECT conv_id, sha256(string_agg(conv_id || chr(0) || role || chr(0) || coalesce(text, '') || chr(0), '' ORDER BY turn)) AS source_sha256 FROM conversations GROUP BY conv_id")
def source_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """One digest of each conversation's turns in order."""
    turns = table(spark, d, "conversations").withColumn("accession", F.col("conv_id").cast("string"))
    return ledger.source_fingerprint(turns, "conv_id", "turn", "accession", "role", "text")


@query("""
SELECT d.doc_id, CASE WHEN source = 'src0' OR coalesce(quality, 0) <> 1 THEN 'low' ELSE 'high' END AS confidence,
  concat_ws('; ', CASE WHEN source = 'src0' THEN 'weak section' END, CASE WHEN coalesce(quality, 0) <> 1 THEN 'quotation not verified' END) AS reasons FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def confidence_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rows.select("doc_id", ledger.confidence(F.col("source"), ["src0"], F.col("quality") == 1).alias("c")).select("doc_id", "c.*")


@query("SELECT doc_id, CAST(round_even(length(text) / 2.66, 0) AS BIGINT) AS n_tokens FROM documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ledger.token_estimate(F.col("text")).alias("n_tokens"))


@query("""
WITH u AS (SELECT o_orderpriority AS model, sum(o_orderkey) AS i, sum(o_custkey) AS o, count(*) AS w FROM orders GROUP BY 1), p(model, ip, op) AS (VALUES ('1-URGENT', 1.0, 5.0), ('2-HIGH', 2.0, 10.0), ('3-MEDIUM', 3.0, 15.0), ('4-NOT SPECIFIED', 4.0, 20.0), ('5-LOW', 5.0, 25.0))
SELECT u.model, round(CAST((ip * (i + 1.25 * w + 0.1 * w) + op * o) / 1e6 AS DOUBLE), 6) AS cost FROM u JOIN p USING (model)""")
def usage_cost(spark: SparkSession, d: str) -> DataFrame:
    """Orders as calls of models: tokens times list prices, with multipliers for cached ones."""
    prices = spark.createDataFrame([("1-URGENT", 1.0, 5.0), ("2-HIGH", 2.0, 10.0), ("3-MEDIUM", 3.0, 15.0), ("4-NOT SPECIFIED", 4.0, 20.0), ("5-LOW", 5.0, 25.0)], "model string, input_price double, output_price double")
    usage = table(spark, d, "orders").select(F.col("o_orderpriority").alias("model"), F.col("o_orderkey").alias("input"), F.col("o_custkey").alias("output"), F.lit(1).alias("cache_write"), F.lit(1).alias("cache_read"))
    return ledger.usage_cost(usage, prices, 1.25, 0.1).select("model", F.round("cost", 6).alias("cost"))


@query("SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS cleaned FROM documents")
def text_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ledger.cleaned(F.col("text")).alias("cleaned"))


def brief(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Documents and an index made from orders: one document a customer, a paragraph an order citing its id and quoting its fact. A customer's orders are a ledger."""
    o = table(spark, d, "orders")
    key = F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 8)
    fact = F.concat(F.lit("EVT-FY2021-"), key)
    quote = F.format_string("the order with status %s was agreed at $%.2f", "o_orderstatus", "o_totalprice")
    index = o.where("o_orderkey % 5 <> 0").select(F.col("o_custkey").alias("scope"), fact.alias("id"), F.when(F.col("o_orderkey") % 3 == 0, "low").otherwise("high").alias("confidence"), (F.col("o_orderkey") % 4 != 0).alias("quote_verified"), quote.alias("quote"), F.lit(None).cast("string").alias("claim"))
    said = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit('It says "'), quote, F.lit('" [')))
    par = F.concat(F.coalesce(said, F.lit("Nothing is quoted [")), F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("XX-FY2021-"), key)).otherwise(fact), F.lit("]."))
    docs = o.groupBy(F.col("o_custkey").alias("doc")).agg(F.array_join(F.array_sort(F.collect_list(par)), "\n\n").alias("body"))
    return docs.select("doc", F.col("doc").alias("scope"), "body", F.lit("x").alias("stamped"), F.lit("x").alias("current"), F.array().cast("array<int>").alias("gap_years")), index


@query("""
SELECT o_custkey AS doc, count(*) FILTER (o_orderkey % 11 <> 0) AS n_citations, count(*) FILTER (o_orderkey % 11 <> 0) AS n_distinct, count(*) FILTER (o_orderkey % 11 <> 0 AND o_orderkey % 5 = 0) AS n_unknown, count(*) FILTER (o_orderkey % 11 = 0) AS n_malformed,
  count(*) FILTER (o_orderkey % 11 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0) AS n_low, count(*) FILTER (o_orderkey % 11 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 4 = 0) AS n_unverified,
  count(*) FILTER (o_orderkey % 11 <> 0 AND o_orderkey % 5 <> 0) AS n_events FROM orders GROUP BY 1""")
def citation_counts(spark: SparkSession, d: str) -> DataFrame:
    """What each document cites."""
    found = checks.citation_report(*brief(spark, d))
    return found.select(*(c for c in found.columns if c != "by_field"), F.coalesce(F.col("by_field")["events"], F.lit(0)).cast("bigint").alias("n_events"))


_BRIEF = """
WITH o AS (
  SELECT o_custkey AS doc, o_orderkey AS k, o_orderkey % 11 <> 0 AS wellformed, o_orderkey % 5 <> 0 AS kept, o_orderkey % 2 = 0 AS quoting, substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS h,
    'the order with status ' || o_orderstatus || ' was agreed at $' || printf('%.2f', o_totalprice) AS quote, printf('%.2f', o_totalprice) AS figure FROM orders
), p AS (
  SELECT *, row_number() OVER (PARTITION BY doc ORDER BY CASE WHEN quoting THEN 'It says "' || quote || '" [' ELSE 'Nothing is quoted [' END || CASE WHEN wellformed THEN 'EVT' ELSE 'XX' END || '-FY2021-' || h || '].') - 1 AS par FROM o
), said AS (
  SELECT doc, par, quote AS said, CASE WHEN wellformed AND kept THEN 'ok' WHEN quote IN (SELECT quote FROM o WHERE kept) THEN 'elsewhere' ELSE 'bad' END AS status FROM p WHERE quoting
)"""


@query(_BRIEF + """
SELECT doc, 'ids_resolve' AS rule, 'EVT-FY2021-' || h AS detail FROM p WHERE wellformed AND NOT kept
UNION ALL SELECT doc, 'ids_wellformed', 'XX-FY2021-' || h FROM p WHERE NOT wellformed
UNION ALL SELECT doc, 'no_unverified_quoted', 'EVT-FY2021-' || h FROM p WHERE wellformed AND kept AND quoting AND k % 4 = 0
UNION ALL SELECT doc, 'low_conf_flagged', 'paragraph ' || par FROM p WHERE wellformed AND kept AND k % 3 = 0
UNION ALL SELECT doc, 'figures_evidenced', figure FROM p WHERE wellformed AND NOT kept AND quoting AND NOT regexp_full_match(figure, '[0-9]{4}')
UNION ALL SELECT doc, 'quotes_verbatim', status || ': ' || said FROM said WHERE status <> 'ok'
UNION ALL SELECT doc, 'sections_present', 'It says' FROM p GROUP BY doc HAVING NOT bool_or(quoting)
UNION ALL SELECT doc, 'length', CAST(sum(CASE WHEN quoting THEN 12 ELSE 4 END) AS VARCHAR) FROM p GROUP BY doc HAVING sum(CASE WHEN quoting THEN 12 ELSE 4 END) NOT BETWEEN 5 AND 5000""")
def document_checks(spark: SparkSession, d: str) -> DataFrame:
    """Every rule that a customer's document breaks."""
    docs, index = brief(spark, d)
    return checks.violations(docs, index, ["It says"], (5, 5000), "regulation fd|reg fd|voluntary disclosure")


@query(_BRIEF + "SELECT DISTINCT doc, par, said, status FROM said")
def quote_checks(spark: SparkSession, d: str) -> DataFrame:
    """Each quotation of a customer's document against the facts of its paragraph, then against all."""
    docs, index = brief(spark, d)
    return checks.quote_report(docs, index).drop("source_id")


@query()
def quote_verify(spark: SparkSession, d: str) -> DataFrame:
    """Each benchmark text as a quotation of the document that `quote_containment` finds for it."""
    from ledgerline.plans.catalogue import QUERIES

    ship(spark)
    found = QUERIES["quote_containment"](spark, d).where("doc_id is not null")
    items, docs = table(spark, d, "benchmark").select("item_id", F.col("text").alias("quote")), table(spark, d, "documents").select("doc_id", F.col("text").alias("source"))
    return found.join(items, "item_id").join(docs, "doc_id").select("item_id", "doc_id", quotes.verify_quote("quote", "source").alias("v")).select("item_id", "doc_id", "v.*")
