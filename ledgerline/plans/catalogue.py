"""The registered queries: one for each operator, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions import text as tx
from ledgerline.operators import attribution, fiscal, ledger, matching, similar
from ledgerline.operators import relational as rel
from ledgerline.sources.shipping import ship
from ledgerline.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn("od", F.to_date("o_orderdate"))


#: Fiscal year ending 30 June, as SQL over a date d.
FY = "CASE WHEN CAST(o_orderdate AS DATE) <= make_date(year(o_orderdate), 6, 30) THEN year(o_orderdate) ELSE year(o_orderdate) + 1 END"


@query("""
WITH g AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)), CAST(o_orderdate AS DATE)) AS gap FROM orders),
a AS (SELECT o_custkey, count(*) AS n_rows, median(gap) AS median_gap_days, min(d) AS first_date, max(d) AS last_date FROM g GROUP BY o_custkey)
SELECT *, CASE WHEN median_gap_days IS NULL THEN 'single filing' WHEN median_gap_days BETWEEN 21 AND 40 THEN '~monthly' WHEN median_gap_days BETWEEN 75 AND 105 THEN '~quarterly'
  WHEN median_gap_days BETWEEN 160 AND 200 THEN '~semi-annual' WHEN median_gap_days < 21 THEN 'clustered' ELSE 'irregular' END AS cadence FROM a""")
def cadence_profile(spark: SparkSession, d: str) -> DataFrame:
    return rel.cadence_profile(orders(spark, d), "o_custkey", "od")


@query(f"""
SELECT o_orderkey, CAST({FY} AS BIGINT) AS fiscal_year, make_date({FY} - 1, 7, 1) AS fy_start, make_date({FY}, 6, 30) AS fy_end FROM orders""")
def fiscal_year_assign(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).withColumn("fy", fiscal.containing(F.col("od"), 6, 30))
    return o.select("o_orderkey", long("fy").alias("fiscal_year"), fiscal.year_start(F.col("fy"), 6, 30).alias("fy_start"), fiscal.year_end(F.col("fy"), 6, 30).alias("fy_end"))


@query("""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y FROM orders)
SELECT o_orderkey, CAST(CASE WHEN abs(date_diff('day', make_date(y, 12, 31), d)) <= 10 THEN y WHEN abs(date_diff('day', make_date(y - 1, 12, 31), d)) <= 10 THEN y - 1
  WHEN abs(date_diff('day', make_date(y + 1, 12, 31), d)) <= 10 THEN y + 1 END AS BIGINT) AS period_year FROM d""")
def fiscal_period_match(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).select("o_orderkey", long(fiscal.from_period(F.col("od"), 12, 31)).alias("period_year"))


YEAR_ENDS = [(12, 31), (1, 31), (3, 31), (6, 30), (9, 30), (2, 29)]


@query("""
WITH e(m, dd) AS (VALUES (12, 31), (1, 31), (3, 31), (6, 30), (9, 30), (2, 29)),
x AS (SELECT o_orderkey, m, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y, CASE WHEN m = 2 AND NOT (year(o_orderdate) % 4 = 0 AND (year(o_orderdate) % 100 <> 0 OR year(o_orderdate) % 400 = 0)) THEN 28 ELSE dd END AS day FROM orders, e)
SELECT o_orderkey, CAST(m AS BIGINT) AS end_month, CAST(CASE WHEN d <= make_date(y, m, day) THEN y - 1 ELSE y END AS BIGINT) AS completed_year FROM x""")
def completed_fiscal_year(spark: SparkSession, d: str) -> DataFrame:
    each = F.array(*(F.struct(F.lit(m).cast("bigint").alias("end_month"), long(fiscal.completed(F.col("od"), m, n)).alias("completed_year")) for m, n in YEAR_ENDS))
    return orders(spark, d).select("o_orderkey", F.explode(each).alias("e")).select("o_orderkey", "e.*")


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'gap_signal' WHEN event_type = 'signup' THEN 'in_scope' WHEN value IS NULL THEN 'out_of_scope'
  WHEN event_type = 'purchase' AND value >= 50 THEN 'in_scope' WHEN value < 10 THEN 'date_only' WHEN event_type IN ('view', 'click') THEN 'triage' ELSE 'out_of_scope' END AS disposition FROM events""")
def rule_classify(spark: SparkSession, d: str) -> DataFrame:
    rules = [("gap_signal", F.col("event_type") == "error"), ("in_scope", F.col("event_type") == "signup"), ("out_of_scope", F.col("value").isNull()), ("in_scope", (F.col("event_type") == "purchase") & (F.col("value") >= 50)), ("date_only", F.col("value") < 10), ("triage", F.col("event_type").isin("view", "click"))]
    chain = F.coalesce(*(F.when(cond, F.lit(name)) for name, cond in rules), F.lit("out_of_scope"))  # precedence is order
    return table(spark, d, "events").select("event_id", chain.alias("disposition"))


@query(f"""
WITH f AS (SELECT CAST({FY} AS BIGINT) AS fiscal_year, o_orderstatus AS s FROM orders)
SELECT fiscal_year, count(*) FILTER (s = 'F') AS n_f, count(*) FILTER (s = 'O') AS n_o, count(*) FILTER (s = 'P') AS n_p,
  CASE WHEN count(*) FILTER (s = 'P') = 0 THEN 'MISSING' ELSE 'ok' END AS p_coverage FROM f GROUP BY fiscal_year""")
def coverage_pivot(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).select(long(fiscal.containing(F.col("od"), 6, 30)).alias("fiscal_year"), "o_orderstatus")
    counts = [F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in "FOP"]
    return o.groupBy("fiscal_year").agg(*counts).withColumn("p_coverage", F.when(F.col("n_p") == 0, "MISSING").otherwise("ok"))


@query("SELECT unnest(string_split(p_type, ' ')) AS item, count(*) AS n FROM part GROUP BY 1")
def item_frequency(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.explode(F.split("p_type", " ")).alias("item")).groupBy("item").agg(F.count("*").alias("n"))


ASOF = """
WITH p AS (SELECT user_id, event_id AS left_id, ts, min(ts) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS bound FROM events WHERE event_type = 'signup'),
m AS (SELECT p.user_id, p.left_id, p.ts, p.bound, min(v.ts) AS vts, min_by(v.event_id, (v.ts, v.event_id)) AS right_id FROM p LEFT JOIN events v ON v.user_id = p.user_id AND v.event_type = 'purchase' AND v.ts > p.ts GROUP BY ALL)
"""


@query(ASOF + "SELECT user_id, left_id, CASE WHEN vts IS NOT NULL AND (bound IS NULL OR vts < bound) THEN right_id END AS right_id FROM m")
def asof_pairing(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return rel.asof_forward(e, "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase", "event_id").drop("gap_reason")


@query(ASOF + "SELECT left_id, CASE WHEN vts IS NULL THEN 'no later row' ELSE 'only after the next one' END AS gap_reason FROM m WHERE vts IS NULL OR (bound IS NOT NULL AND vts >= bound)")
def pairing_gaps(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return rel.asof_forward(e, "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase", "event_id").where("gap_reason is not null").select("left_id", "gap_reason")


@query("""
SELECT o_orderkey, o_orderstatus, round(CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS o_totalprice FROM orders""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)  # the later run of the fixture
    return rel.upsert(o, new, ["o_orderkey"]).withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("SELECT doc_id, rank() OVER (PARTITION BY text ORDER BY source, doc_id) AS choice_rank, rank() OVER (PARTITION BY text ORDER BY source, doc_id) = 1 AS chosen FROM documents")
def choose_rendition(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return rel.choose_one(docs, ["h"], ["source", "doc_id"]).select("doc_id", "choice_rank", "chosen")


@query("""
SELECT o_orderkey, 'in window' AS why FROM orders WHERE year(o_orderdate) = 1996 AND o_orderstatus IN ('O', 'P') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')
UNION ALL SELECT o_orderkey, 'look-ahead' FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 1 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def work_list(spark: SparkSession, d: str) -> DataFrame:
    o, line = orders(spark, d), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    main = o.where((F.year("od") == 1996) & F.col("o_orderstatus").isin("O", "P")).join(line.where("l_returnflag <> 'R'"), "o_orderkey", "left_semi")
    ahead = o.where((F.year("od") == 1997) & (F.month("od") == 1)).join(line.where("l_returnflag = 'R'"), "o_orderkey", "left_anti")
    return main.select("o_orderkey", F.lit("in window").alias("why")).union(ahead.select("o_orderkey", F.lit("look-ahead").alias("why")))


@query("SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, o_orderkey AS ids, o_orderstatus AS states FROM orders")
def parallel_array_flatten(spark: SparkSession, d: str) -> DataFrame:
    packed = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("s"))
    return rel.flatten_parallel(packed.select("o_custkey", F.col("s.o_orderkey").alias("ids"), F.col("s.o_orderstatus").alias("states")), "o_custkey", ["ids", "states"])


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[0-9]+'))), ',') AS items FROM documents")
def item_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(tx.items_in(F.col("text"), "[0-9]+"), ",").alias("items"))


@query("SELECT doc_id, CAST(len(regexp_extract_all(regexp_replace(text, '[^ \\t\\n]+\\.(jpg|jpeg|png|gif)', ' ', 'g'), '[A-Za-z]{2,}')) AS BIGINT) AS n_words FROM documents")
def substantive_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tx.substantive_words(F.col("text")).alias("n_words"))


#: Signals of the scan: name and phrase, and the offset before which a hit is strong.
SIGNALS, STRONG_BEFORE = [("narrative", "the that"), ("material", "mail"), ("routine", "der die"), ("routine", "de la")], 1200
_SCAN = f"WITH s(signal, phrase) AS (VALUES {', '.join(map(str, SIGNALS))}), hits AS (SELECT doc_id, signal, min(strpos(lower(text), phrase)) AS first_at, count(*) AS n_patterns FROM documents, s WHERE contains(lower(text), phrase) GROUP BY ALL)"


def signals(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower("text")
    each = F.array(*(F.struct(F.lit(s).alias("signal"), F.instr(low, p).alias("at")) for s, p in SIGNALS))
    found = table(spark, d, "documents").select("doc_id", F.explode(each).alias("e")).where("e.at > 0")
    hits = found.groupBy("doc_id", "e.signal").agg(long(F.min("e.at")).alias("first_at"), F.count("*").alias("n_patterns"))
    return hits.withColumn("strength", F.when(F.col("first_at") <= STRONG_BEFORE, "strong").otherwise("mention"))


@query(_SCAN + f" SELECT *, CASE WHEN first_at <= {STRONG_BEFORE} THEN 'strong' ELSE 'mention' END AS strength FROM hits")
def signal_scan(spark: SparkSession, d: str) -> DataFrame:
    return signals(spark, d)


@query(_SCAN + f""", b AS (SELECT doc_id, bool_or(signal = 'material' AND first_at <= {STRONG_BEFORE}) AS sm, bool_or(signal = 'narrative') AS n, bool_or(signal = 'routine' AND first_at <= {STRONG_BEFORE}) AS sr, bool_or(signal = 'material') AS m FROM hits GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN sm THEN 'events' WHEN n THEN 'investor_qa' WHEN sr AND NOT m THEN 'drop' ELSE 'read' END AS route FROM documents d LEFT JOIN b USING (doc_id)""")
def triage_decide(spark: SparkSession, d: str) -> DataFrame:
    s, strong = F.col("signal"), F.col("strength") == "strong"
    flags = signals(spark, d).groupBy("doc_id").agg(F.bool_or((s == "material") & strong).alias("sm"), F.bool_or(s == "narrative").alias("n"), F.bool_or((s == "routine") & strong).alias("sr"), F.bool_or(s == "material").alias("m"))
    route = F.when(F.col("sm"), "events").when(F.col("n"), "investor_qa").when(F.col("sr") & ~F.col("m"), "drop").otherwise("read")
    return table(spark, d, "documents").select("doc_id").join(flags, "doc_id", "left").select("doc_id", route.alias("route"))


#: The patterns of `boilerplate_strip`, by words that the texts have.
BOILERPLATE = {"starts": r"\bthe\b", "ends": r"\blicen[cs]e\b", "caution": r"\band\b", "caution_end": r"\bof\b", "head": r"^\S+ ", "image": r"\S+\.(?:jpg|png)\b"}


@query(r"""
WITH t AS (SELECT doc_id, regexp_replace(text, '\s+', ' ', 'g') AS t, doc_id % 2 = 0 AS body FROM documents), s AS (SELECT doc_id, t, body, CASE WHEN regexp_matches(t, '\bthe\b') THEN regexp_extract(t, '\bthe\b.*') ELSE t END AS b FROM t),
e AS (SELECT doc_id, t, body, regexp_replace(b, '\blicen[cs]e\b.*$', '') AS b FROM s), c AS (SELECT *, regexp_replace(b, '\band\b.*?(\bof\b)', ' [... standard forward-looking-statements caution omitted ...] \1') AS o FROM e)
SELECT doc_id, trim(regexp_replace(CASE WHEN body THEN o ELSE regexp_replace(regexp_replace(t, '^\S+ ', ''), '\S+\.(?:jpg|png)\b', '', 'g') END, '\s+', ' ', 'g')) AS stripped FROM c""")
def boilerplate_strip(spark: SparkSession, d: str) -> DataFrame:
    """Documents as bodies and exhibits of filings, without what all of them have."""
    return table(spark, d, "documents").select("doc_id", ledger.without_boilerplate(F.col("text"), F.col("doc_id") % 2 == 0, BOILERPLATE).alias("stripped"))


@query()
def canon_text(spark: SparkSession, d: str) -> DataFrame:
    ship(spark)
    return table(spark, d, "documents").select("doc_id", tx.canon_text("text").alias("canon"))


@query("""
SELECT item_id, min(d.doc_id) AS doc_id FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY item_id""")
def quote_containment(spark: SparkSession, d: str) -> DataFrame:
    """Each quotation's first source whose text holds it: an automaton over all quotations reads each text once."""
    b = table(spark, d, "benchmark").select("item_id", F.col("text").alias("quote"))
    hits = attribution.first_containing(b, table(spark, d, "documents").select(F.col("doc_id").alias("source_id"), "text"))
    return b.join(hits, "quote", "left").select("item_id", F.col("source_id").alias("doc_id"))


@query("""
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_paragraphs, CAST(len(regexp_extract_all(text, '[.!?:;]([ \\n]|$)')) AS BIGINT) AS n_sentences, CAST(len(regexp_extract_all(text, '[^ \\t\\n]+')) AS BIGINT) AS n_words FROM documents""")
def paragraph_stats(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", long(F.size(F.split(c, "\n"))).alias("n_paragraphs"), long(F.regexp_count(c, F.lit(r"[.!?:;]([ \n]|$)"))).alias("n_sentences"), long(F.regexp_count(c, F.lit(r"[^ \t\n]+"))).alias("n_words"))


@query("""
WITH n AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9][0-9,]*(\\.[0-9]+)?')) AS raw FROM documents)
SELECT doc_id, regexp_replace(replace(raw, ',', ''), '\\.0$', '') AS figure, count(*) AS n FROM n WHERE length(replace(raw, ',', '')) >= 3 GROUP BY ALL""")
def numeric_extract(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[0-9][0-9,]*(\.[0-9]+)?"), F.lit(0))).alias("raw"))
    plain = raw.withColumn("plain", F.replace("raw", F.lit(","), F.lit(""))).where(F.length("plain") >= 3)
    return plain.select("doc_id", F.regexp_replace("plain", r"\.0$", "").alias("figure")).groupBy("doc_id", "figure").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'quoted' WHEN 1 THEN 'thin' ELSE 'unsourced' END AS tier FROM orders""")
def evidence_tiers(spark: SparkSession, d: str) -> DataFrame:
    figure = F.format_string("%.2f", F.col("o_totalprice"))
    k = F.col("o_orderkey") % 3
    facts = table(spark, d, "orders").select("o_orderkey", figure.alias("figure"), F.when(k == 0, F.concat(F.lit("total of $"), figure, F.lit(" was agreed"))).otherwise("no figure").alias("quote"), F.when(k <= 1, F.concat(F.lit("claims "), figure)).otherwise("none").alias("claim"))
    numbers = lambda c: F.regexp_extract_all(c, F.lit(r"[0-9]+(\.[0-9]+)?"), F.lit(0))
    tier = F.when(F.array_contains(numbers(F.col("quote")), F.col("figure")), "quoted").when(F.array_contains(numbers(F.col("claim")), F.col("figure")), "thin").otherwise("unsourced")
    return facts.select("o_orderkey", tier.alias("tier"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'malformed' WHEN o_orderkey % 7 = 0 THEN 'unknown' ELSE 'known' END AS status FROM orders""")
def citation_resolve(spark: SparkSession, d: str) -> DataFrame:
    """Ids cited in text against an index: known, unknown, or of no known field code."""
    o = table(spark, d, "orders")
    cited = o.select("o_orderkey", F.format_string("as agreed [%s-FY2021-%d]", F.when(F.col("o_orderkey") % 11 == 0, "XX").otherwise("EVT"), F.when(F.col("o_orderkey") % 7 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))).alias("body"))
    ids = cited.select("o_orderkey", F.regexp_extract("body", r"\[([A-Z]{2,8}-FY\d{4}--?\d+)\]", 1).alias("id"))
    index = o.select(F.format_string("EVT-FY2021-%d", "o_orderkey").alias("id"), F.lit(True).alias("known"))
    status = F.when(~F.col("id").rlike("^(EVT|LEAD|QA)-"), "malformed").when(F.col("known"), "known").otherwise("unknown")
    return ids.join(index, "id", "left").select("o_orderkey", status.alias("status"))


_CANON = "'{\"custkey\": ' || o_custkey || ', \"status\": \"' || o_orderstatus || '\"}'"


def canonical_order() -> Column:
    return F.concat(F.lit('{"custkey": '), F.col("o_custkey").cast("string"), F.lit(', "status": "'), F.col("o_orderstatus"), F.lit('"}'))


@query(f"SELECT o_orderkey, 'EVT-FY' || year(o_orderdate) || '-' || substr(sha256({_CANON}), 1, 8) AS fact_id FROM orders")
def content_hash_id(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).select("o_orderkey", tx.short_id("EVT", F.year("od"), canonical_order()).alias("fact_id"))


@query("SELECT substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 4) AS short_id, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def collision_audit(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "orders").select(F.substring(F.sha2(F.col("o_orderkey").cast("string"), 256), 1, 4).alias("short_id"))
    return ids.groupBy("short_id").agg(F.count("*").alias("n")).where("n > 1")


@query()
def fuzzy_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Parts of one brand and size whose names' token-set score is 55 or more: pairs of the first parts of their names, and each further part of a name with the first (100)."""
    block = F.when(F.col("p_brand").isNotNull() & F.col("p_size").isNotNull(), F.struct("p_brand", "p_size"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), block.alias("block"), F.col("p_name").alias("text"), F.array().cast("array<string>").alias("sources"))
    return similar.in_blocks(rows, 55).select("a", "b", F.round("score", 4).alias("score"))


@query()
def greedy_match(spark: SparkSession, d: str) -> DataFrame:
    ship(spark)
    p = table(spark, d, "part").withColumn("block", F.concat("p_brand", F.lit("/"), "p_size"))
    split = p.withColumn("half", F.col("p_partkey") % 2)
    return matching.greedy_match(split.where("half = 1"), split.where("half = 0"), "block", "p_partkey", "p_name")


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS component FROM documents")
def components(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return docs.join(rel.components_by_block(docs, "h", "doc_id"), "h").select("doc_id", "component")


@query("""
WITH c AS (SELECT min(doc_id) OVER (PARTITION BY text) AS component, doc_id, source, n_chars FROM documents), m AS (SELECT component, source, count(*) AS n, min(doc_id) AS seen FROM c GROUP BY ALL)
SELECT c.component, count(*) AS members, max(n_chars) AS longest, (SELECT arg_min(source, (-n, seen)) FROM m WHERE m.component = c.component) AS modal_source FROM c GROUP BY c.component""")
def merge_cluster(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars", F.sha2("text", 256).alias("h"))
    by_source = docs.groupBy("h", "source").agg(F.count("*").alias("n"), F.min("doc_id").alias("seen"), F.max("n_chars").alias("longest"))
    out = by_source.groupBy("h").agg(F.min("seen").alias("component"), F.sum("n").alias("members"), F.max("longest").alias("longest"), F.min_by("source", F.struct(-F.col("n"), F.col("seen"))).alias("modal_source"))
    return out.drop("h")


@query("SELECT o_custkey, o_orderpriority, o_orderstatus, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_dates FROM orders GROUP BY ALL HAVING count(DISTINCT CAST(o_orderdate AS DATE)) > 1")
def date_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).groupBy("o_custkey", "o_orderpriority", "o_orderstatus").agg(F.count_distinct("od").alias("n_dates")).where("n_dates > 1")


@query(f"""
WITH y AS (SELECT CAST({FY} AS BIGINT) AS fiscal_year, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
SELECT c.fiscal_year, c.o_orderpriority, c.n, p.n AS baseline, c.n - p.n AS delta, CASE WHEN p.n IS NULL THEN 'no prior year' END AS unavailable_reason FROM y c LEFT JOIN y p ON p.fiscal_year = c.fiscal_year - 1 AND p.o_orderpriority = c.o_orderpriority""")
def yoy_delta(spark: SparkSession, d: str) -> DataFrame:
    counts = orders(spark, d).groupBy(long(fiscal.containing(F.col("od"), 6, 30)).alias("fiscal_year"), "o_orderpriority").agg(F.count("*").alias("n"))
    return rel.year_over_year(counts, "fiscal_year", ["o_orderpriority"], "n")


@query()
def html_nodes(spark: SparkSession, d: str) -> DataFrame:
    ship(spark)
    return matching.html_nodes(table(spark, d, "pages"), "page_id", "html")


@query("""
WITH a AS (SELECT source || lang AS source, doc_id, n_chars, CAST((length(text) - length(replace(text, ' the ', ''))) / 5 AS BIGINT) AS score FROM documents), m AS (SELECT *, max(score) OVER (PARTITION BY source) AS peak FROM a)
SELECT source, CASE WHEN max(peak) > 0 THEN arg_min(doc_id, (n_chars, doc_id)) FILTER (score >= 0.9 * peak) ELSE arg_min(doc_id, (-n_chars, doc_id)) END AS doc_id, max(peak) AS peak FROM m GROUP BY source""")
def anchor_select(spark: SparkSession, d: str) -> DataFrame:
    hits = long((F.length("text") - F.length(F.replace("text", F.lit(" the "), F.lit("")))) / 5)
    scored = table(spark, d, "documents").select(F.concat("source", "lang").alias("source"), "doc_id", "n_chars", hits.alias("score"))
    peak = scored.groupBy("source").agg(F.max("score").alias("peak"))  # a grouped maximum, not a window: a hot source stays split
    # among nine tenths of the peak the tightest; where nothing has an anchor, the largest
    rank = F.when(F.col("peak") == 0, F.struct((-F.col("n_chars")).alias("n_chars"), "doc_id")).when(F.col("score") >= 0.9 * F.col("peak"), F.struct("n_chars", "doc_id"))
    return scored.join(peak, "source").groupBy("source").agg(F.min_by("doc_id", rank).alias("doc_id"), F.max("peak").alias("peak"))


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS since_signup FROM events")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    return rel.carry_forward(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "since_signup").select("event_id", "since_signup")


@query("""
WITH e AS (SELECT *, coalesce(lag(CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS ended FROM events),
g AS (SELECT *, sum(ended) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e)
SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(event_id) AS first_id FROM g GROUP BY ALL""")
def island_merge(spark: SparkSession, d: str) -> DataFrame:
    g = rel.island_ids(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") != "view", "island")
    return g.groupBy("user_id", long("island").alias("island")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("""
SELECT d.lang, count(*) AS n, count(*) FILTER (l.quality = 1) AS high, count(*) FILTER (l.quality = 0) AS low, count(*) FILTER (l.doc_id IS NULL) AS unverified, array_to_string(list_sort(list(DISTINCT d.source)), ',') AS sources FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.lang""")
def quality_block(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "documents").select("doc_id", "lang", "source").join(table(spark, d, "labels").withColumn("seen", F.lit(True)), "doc_id", "left")
    return joined.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("high"), F.count_if(F.col("quality") == 0).alias("low"), F.count_if(F.col("seen").isNull()).alias("unverified"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


@query("""
WITH f(k, expected, v) AS (VALUES (1, (SELECT c_mktsegment FROM customer WHERE c_custkey = 1), 'FIXED'), (2, 'NO SUCH', 'FIXED'))
SELECT c_custkey, CASE WHEN f.expected = c.c_mktsegment THEN f.v ELSE c.c_mktsegment END AS c_mktsegment, coalesce(f.expected = c.c_mktsegment, false) AS corrected FROM customer c LEFT JOIN f ON f.k = c.c_custkey""")
def corrections_apply(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    true_one = c.where("c_custkey = 1").select("c_custkey", F.col("c_mktsegment").alias("expected"), F.lit("FIXED").alias("new_value"))
    fixes = true_one.union(spark.range(2, 3).select(F.col("id"), F.lit("NO SUCH"), F.lit("FIXED")))
    return rel.apply_corrections(c, fixes, "c_custkey", "c_mktsegment", "c_mktsegment")[0]


@query("""
WITH d AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents), b AS (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark),
x AS (SELECT word, 1 AS s FROM b UNION ALL SELECT word, -1 FROM d) SELECT word, CAST(sum(s) AS BIGINT) AS surplus FROM x GROUP BY word HAVING sum(s) > 0""")
def multiset_difference(spark: SparkSession, d: str) -> DataFrame:
    words = lambda n: table(spark, d, n).select(F.explode(F.split("text", " ")).alias("word"))
    return rel.multiset_difference(words("benchmark"), words("documents"), "word")


@query("""
WITH r AS (SELECT p_brand, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
SELECT p_brand, CAST(cents AS BIGINT) AS cents, round(cents / sum(cents) OVER (), 6) AS share FROM r QUALIFY row_number() OVER (ORDER BY cents DESC, p_brand) <= 3""")
def topk_share(spark: SparkSession, d: str) -> DataFrame:
    sales = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    by_brand = sales.groupBy("p_brand").agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"))
    total = by_brand.agg(F.sum("cents").alias("total"))
    top = by_brand.orderBy(F.desc("cents"), "p_brand").limit(3)  # a top-k report
    return top.join(F.broadcast(total)).select("p_brand", "cents", F.round(F.col("cents") / F.col("total"), 6).alias("share"))


@query("SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'missing' WHEN doc_id % 5 = 0 THEN 'stale' ELSE 'fresh' END AS status FROM documents")
def staleness_check(spark: SparkSession, d: str) -> DataFrame:
    now = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    stored = table(spark, d, "documents").where("doc_id % 9 <> 0").select("doc_id", F.sha2(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("stored"))
    status = F.when(F.col("stored").isNull(), "missing").when(F.col("stored") != F.col("sha"), "stale").otherwise("fresh")
    return now.join(stored, "doc_id", "left").select("doc_id", status.alias("status"))


@query("""
WITH l(rung) AS (VALUES (100), (200), (400), (800)), t AS (SELECT source, rung, sum(least(length(text), rung)) AS total FROM documents, l GROUP BY ALL)
SELECT source, CAST(coalesce(max(CASE WHEN total <= 40000 THEN rung END), 100) AS BIGINT) AS rung, count(*) FILTER (total <= 40000) > 0 AS fits FROM t GROUP BY source""")
def budget_ladder(spark: SparkSession, d: str) -> DataFrame:
    return rel.budget_rung(table(spark, d, "documents"), "source", F.length("text"), [100, 200, 400, 800], 40_000).select("source", long("rung").alias("rung"), "fits")


@query("""
SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS other, true AS reconciles FROM orders""")
def reconcile_counts(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("o_orderstatus")
    out = table(spark, d, "orders").agg(F.count("*").alias("total"), F.count_if(s == "F").alias("done"), F.count_if(s == "O").alias("open"), F.count_if(~s.isin("F", "O")).alias("other"))
    return out.withColumn("reconciles", F.col("done") + F.col("open") + F.col("other") == F.col("total"))


def _timeline(o: DataFrame) -> DataFrame:
    """Dated rows in text order of their partial dates, undated rows on their own."""
    k = F.col("o_orderkey") % 4
    partial = F.when(k == 1, F.date_format("od", "yyyy")).when(k == 2, F.date_format("od", "yyyy-MM")).when(k == 3, F.date_format("od", "yyyy-MM-dd"))
    t = o.select("o_orderkey", partial.alias("partial_date")).withColumn("undated", F.col("partial_date").isNull())
    n = F.length("partial_date")
    kind = F.when(n == 4, "year").when(n == 7, "month").when(n == 10, "day").otherwise("undated")
    t = rel.positions(t, "undated", ["partial_date", "o_orderkey"], "position")
    return t.select("o_orderkey", "partial_date", kind.alias("date_precision"), long("position").alias("position"))


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN strftime(o_orderdate, '%Y') WHEN 2 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)
SELECT o_orderkey, d AS partial_date, CASE length(d) WHEN 4 THEN 'year' WHEN 7 THEN 'month' WHEN 10 THEN 'day' ELSE 'undated' END AS date_precision, row_number() OVER (PARTITION BY d IS NULL ORDER BY d, o_orderkey) AS position FROM t""")
def timeline_order(spark: SparkSession, d: str) -> DataFrame:
    """The timeline of all orders."""
    return _timeline(orders(spark, d))


@query("""
SELECT 'order_without_customer' AS rule, o_orderkey AS key FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'negative_price', o_orderkey FROM orders WHERE o_totalprice < 0
UNION ALL SELECT 'document_without_label', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'negative_balance', c_custkey FROM customer WHERE c_acctbal < 0""")
def verify_checks(spark: SparkSession, d: str) -> DataFrame:
    """Violations, which must be empty for a document to pass: one row for each rule and key."""
    o, c, docs, labels = (table(spark, d, n) for n in ("orders", "customer", "documents", "labels"))
    row = lambda df, rule, key: df.select(F.lit(rule).alias("rule"), F.col(key).alias("key"))
    parts = [row(o.join(c, o.o_custkey == c.c_custkey, "left_anti"), "order_without_customer", "o_orderkey"), row(o.where("o_totalprice < 0"), "negative_price", "o_orderkey"), row(docs.join(labels, "doc_id", "left_anti"), "document_without_label", "doc_id"), row(c.where("c_acctbal < 0"), "negative_balance", "c_custkey")]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])
