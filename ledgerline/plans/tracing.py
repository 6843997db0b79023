"""Registered queries of attribution, the timeline, ids of changes and corrections of documents, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import glyphs, tables, values
from ledgerline.operators import attribution, build, edits, filings, graph, ledger, letters, matching, pack, sections, similar, timeline, triage
from ledgerline.plans.catalogue import query
from ledgerline.sources.shipping import ship
from ledgerline.sources.tables import table

_CANON = r"lower(trim(regexp_replace(regexp_replace(translate(nfc_normalize({}), '‘’‚“”„ ‐‑‒–—―−', '''''''\"\"\" -------'), '(?i)\S+\.(?:jpg|jpeg|png|gif)\b', ' ', 'g'), '\s+', ' ', 'g')))".replace('\\"', '"')


@query(rf"""
WITH facts AS (
  SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN substr(text, 11, 60) WHEN 1 THEN substr(text, 11, 60) || 'q#' WHEN 2 THEN substr(text, 11, 30) || ' was not said like this at all' WHEN 3 THEN 'nothing of this kind was ever written anywhere' ELSE substr(text, 11, 20) END AS quote FROM documents
), listed AS (
  SELECT doc_id, doc_id + 1 AS source_id, 0 AS place FROM documents UNION ALL SELECT doc_id, doc_id, 1 FROM documents UNION ALL SELECT doc_id, doc_id // 2, 2 FROM documents WHERE doc_id // 2 NOT IN (doc_id, doc_id + 1)
), folded AS (
  SELECT doc_id, {_CANON.format("quote")} AS q FROM facts
), sources AS (
  SELECT doc_id AS source_id, {_CANON.format("text")} AS hay FROM documents
), same AS (
  SELECT l.doc_id, l.place, l.source_id, len(q) AS n, CASE WHEN contains(hay, q) THEN len(q) ELSE len(list_filter(range(1, len(q)), lambda k: contains(hay, substr(q, 1, k)))) END AS k
  FROM listed l JOIN folded f USING (doc_id) JOIN sources s USING (source_id)
), held AS (
  SELECT doc_id, min_by(struct_pack(source_id := source_id, why := CASE WHEN k = n THEN 'verbatim' ELSE 'stray tail' END), place) AS hit FROM same WHERE n >= 25 AND k >= 25 AND n - k <= 3 GROUP BY doc_id
)
SELECT doc_id, hit.source_id AS source_id, hit IS NOT NULL AS verified, hit.why AS why FROM facts LEFT JOIN held USING (doc_id)""")
def attribution_by_list(spark: SparkSession, d: str) -> DataFrame:
    """Each document as a fact that quotes it, more or less exactly, and lists the next document, itself, and another one."""
    docs, k = table(spark, d, "documents"), F.col("doc_id")
    part = lambda n: F.substring("text", 11, n)
    quote = F.when(k % 5 == 0, part(60)).when(k % 5 == 1, F.concat(part(60), F.lit("q#"))).when(k % 5 == 2, F.concat(part(30), F.lit(" was not said like this at all"))).when(k % 5 == 3, "nothing of this kind was ever written anywhere").otherwise(part(20))
    listing = docs.select(k.alias("fact_id"), F.posexplode(F.array(k + 1, k, F.floor(k / 2))).alias("place", "source_id"))
    got = attribution.attribute(docs.select(k.alias("fact_id"), quote.alias("quote")), listing, docs.select(k.alias("source_id"), "text"))
    return got.select(F.col("fact_id").alias("doc_id"), "source_id", "verified", F.when(F.col("verified"), F.col("why")).alias("why"))


@query()
def similar_clients(spark: SparkSession, d: str) -> DataFrame:
    """Clients of different sources whose names are alike, over all clients."""
    rows = table(spark, d, "clients").select(F.col("client_id").alias("id"), F.col("name").alias("text"), F.array("source").alias("sources"))
    return similar.across(rows, 95)


@query()
def same_block_clients(spark: SparkSession, d: str) -> DataFrame:
    """Clients of different sources and one family name in their address whose names are more alike than not."""
    block = F.nullif(F.regexp_extract("email", "^[^0-9@]+", 0), F.lit(""))
    rows = table(spark, d, "clients").select(F.col("client_id").alias("id"), block.alias("block"), F.col("name").alias("text"), F.array("source").alias("sources"))
    return similar.in_blocks(rows, 55)


@query("""
WITH RECURSIVE pairs AS (
  SELECT client_id AS a, master_id AS b FROM clients WHERE master_id IS NOT NULL
  UNION ALL SELECT client_id, min(client_id) OVER (PARTITION BY email) FROM clients WHERE email IS NOT NULL
), edges AS (SELECT DISTINCT a, b FROM (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs) WHERE a IS NOT NULL AND b IS NOT NULL), reach AS (
  SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b
) SELECT a AS node, min(b) AS root FROM reach GROUP BY a""")
def client_components(spark: SparkSession, d: str) -> DataFrame:
    """Clients joined by their master or their address, and the smallest of each group."""
    c = table(spark, d, "clients").select("client_id", "master_id", "email")
    first = c.where("email is not null").groupBy("email").agg(F.min("client_id").alias("first"))
    edges = c.select(F.col("client_id").alias("a"), F.col("master_id").alias("b")).union(c.join(first, "email").select("client_id", "first"))
    return graph.components(edges)


def change_reports(spark: SparkSession, d: str) -> DataFrame:
    """Changes of clients as reports: a client is a day, its source the filing."""
    c, k = table(spark, d, "client_changes").dropDuplicates(["change_id"]), F.col("change_id")
    day = F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.pmod("client_id", F.lit(2_000_000)).cast("int")), "yyyy-MM-dd")
    return c.select(F.concat(F.lit("E"), k).alias("id"), k.alias("position"), F.when(k % 3 == 0, "leadership").otherwise("events").alias("field"), F.when(k % 4 == 0, "other").otherwise(F.col("op")).alias("type"), F.when(F.col("city").isNotNull(), day).alias("stated"), F.concat_ws(" ", "city", "segment").alias("description"), F.col("segment").alias("quote"), F.col("source").alias("accession"), F.col("source").alias("source"), F.when(k % 5 == 0, "low").otherwise("high").alias("confidence"), (F.lit(2020) + k % 4).alias("fiscal_year"), "city")


@query("""
WITH c AS (
  SELECT DISTINCT ON (change_id) change_id AS k, client_id, source, city, concat_ws(' ', city, segment) AS description, segment, CASE WHEN change_id % 4 = 0 THEN 'other' ELSE op END AS type, CASE WHEN change_id % 3 = 0 THEN 'leadership' ELSE 'events' END AS field,
    CASE WHEN change_id % 5 = 0 THEN 'low' ELSE 'high' END AS confidence, 2020 + change_id % 4 AS fy FROM client_changes
), g AS (
  SELECT *, CASE WHEN city IS NOT NULL AND count(DISTINCT source) OVER (PARTITION BY client_id, city) > 1 AND source IS NOT NULL THEN client_id || '|' || city ELSE 'one ' || k END AS cluster FROM c
), m AS (
  SELECT cluster, count(*) AS n, list(k ORDER BY k) AS ks, list(DISTINCT 'E' || k ORDER BY 'E' || k) AS ids, list(DISTINCT fy ORDER BY fy) AS years, list(DISTINCT source ORDER BY source) FILTER (source IS NOT NULL) AS sources, bool_or(field = 'events') AS any_event, first(field ORDER BY k) AS field,
    first(type ORDER BY k) AS type, arg_min(description, (-length(description), k)) AS longest, bool_or(confidence <> 'high') AS low, first(confidence ORDER BY k) AS confidence, list(DISTINCT type ORDER BY type) FILTER (type <> 'other') AS specific FROM g GROUP BY cluster
), t AS (
  SELECT cluster, arg_min(type, (-n, first)) AS modal FROM (SELECT cluster, type, count(*) AS n, min(k) AS first FROM g WHERE type <> 'other' GROUP BY ALL) GROUP BY cluster
)
SELECT array_to_string(ids, ',') AS ids, array_to_string(years, ',') AS years, CASE WHEN n = 1 THEN field WHEN any_event THEN 'events' ELSE 'leadership' END AS field, CASE WHEN n = 1 THEN type ELSE coalesce(modal, 'other') END AS type,
  CASE WHEN n > 1 AND len(specific) > 1 THEN array_to_string(specific, ',') END AS types_disagree, longest AS description, n - 1 AS n_also, coalesce(array_to_string(sources, ','), '') AS accessions, CASE WHEN n = 1 THEN confidence WHEN low THEN 'low' ELSE 'high' END AS confidence,
  CAST(coalesce(len(sources), 0) AS BIGINT) AS corroborating, regexp_matches(longest, 'retail') AND NOT regexp_matches(longest, 'port') AS routine FROM m LEFT JOIN t USING (cluster)""")
def timeline_merge(spark: SparkSession, d: str) -> DataFrame:
    """Changes of one client that put it into one city, as told by different sources, are one event."""
    rows = change_reports(spark, d)
    told = rows.where("city is not null and accession is not null").select(F.col("stated").alias("date"), "city", "position", "accession")
    first = told.groupBy("date", "city", "accession").agg(F.min("position").alias("position"))
    ends = first.groupBy("date", "city").agg(F.min_by(F.struct("position", "accession"), "position").alias("low"), F.count("*").alias("n")).where("n > 1")
    other = first.join(ends, ["date", "city"]).where("accession <> low.accession").groupBy("date", "city").agg(F.min("position").alias("other"))
    joined = told.join(ends, ["date", "city"]).join(other, ["date", "city"])
    pairs = joined.select("date", F.when(F.col("accession") == F.col("low.accession"), F.col("other")).otherwise(F.col("low.position")).alias("a"), F.col("position").alias("b"), F.lit(True).alias("merges"))
    e = timeline.merged(rows.drop("city"), pairs, ["retail"], ["port"])
    joined_text = lambda c: F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")
    return e.select(joined_text("ids").alias("ids"), joined_text("fiscal_years").alias("years"), "field", "type", joined_text("types_disagree").alias("types_disagree"), "description", F.greatest(F.size(F.coalesce("also_described_as", F.array().cast("array<string>"))), F.lit(0)).cast("bigint").alias("n_also"), joined_text("accessions").alias("accessions"), "confidence", "corroborating", "routine")


@query()
def timeline_events(spark: SparkSession, d: str) -> DataFrame:
    """The timeline of all changes of clients: alike reports of one day and different sources are one event."""
    rows = change_reports(spark, d).drop("city")
    return timeline.merged(rows, timeline.same_date_pairs(rows), ["retail"], ["port"])


@query("""
WITH c AS (SELECT client_id, lower(trim(coalesce(name, ''))) || ' | ' || lower(trim(coalesce(segment, ''))) || ' | ' AS identity, strftime(updated_at, '%Y-%m-%d') AS date, source, client_id % 3 = 0 AS amended, client_id % 2 = 0 AS back FROM clients WHERE updated_at IS NOT NULL),
g AS (SELECT identity, list(DISTINCT date ORDER BY date) AS dates, count(*) FILTER (amended) AS n, max(date) FILTER (amended) AS d, bool_or(back) FILTER (amended) AS back, list(client_id ORDER BY 'E' || client_id) AS ids FROM c GROUP BY identity)
SELECT identity, array_to_string(dates, ',') AS dates, n = 1 AND coalesce(back, false) AS resolved, CASE WHEN n = 1 AND back THEN d END AS resolved_date, CAST(len(ids) AS BIGINT) AS n_reports FROM g WHERE len(dates) > 1""")
def conflicting_dates(spark: SparkSession, d: str) -> DataFrame:
    """Clients of one name and segment as changes of leadership, dated by when they were updated."""
    k = F.col("client_id")
    rows = table(spark, d, "clients").select(F.concat(F.lit("E"), k).alias("id"), timeline.identity(F.col("name"), F.col("segment"), F.lit(None).cast("string")).alias("identity"), F.date_format("updated_at", "yyyy-MM-dd").alias("stated"), F.col("source").alias("accession"), F.when(k % 3 == 0, "8-K/A").otherwise("8-K").alias("form"), F.when(k % 2 == 0, "As previously reported, it changed").otherwise("It changed").alias("quote"))
    found = timeline.date_conflicts(rows)
    return found.select("identity", F.array_join("dates", ",").alias("dates"), "resolved", "resolved_date", F.size("ids").cast("bigint").alias("n_reports"))


@query("""
WITH c AS (SELECT client_id, nullif(name, '') AS n, nullif(replace(segment, '_', ' '), '') AS s, nullif(city, '') AS c FROM clients)
SELECT client_id, CASE WHEN n IS NOT NULL AND s IS NOT NULL AND c IS NOT NULL THEN n || ' ' || s || ' — ' || c ELSE concat_ws(' ', n, s, c) END || CASE WHEN client_id % 2 = 0 THEN ' (stated reason: even)' ELSE '' END AS sentence FROM c""")
def leadership_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Clients as sentences about who did what where."""
    reason = F.when(F.col("client_id") % 2 == 0, "even")
    return table(spark, d, "clients").select("client_id", timeline.leadership_sentence(F.col("name"), F.col("segment"), F.col("city"), reason).alias("sentence"))


@query(r"""
WITH t AS (SELECT doc_id, text, substr(text, 3, 12) AS f1, 'of' || chr(10) AS f2 FROM documents),
a AS (SELECT *, CASE WHEN length(f1) = 0 THEN 0 ELSE coalesce((length(text) - length(replace(text, f1, ''))) // nullif(length(f1), 0), 0) END AS n1 FROM t),
b AS (SELECT *, CASE WHEN n1 = 1 THEN replace(text, f1, 'X' || f2) ELSE text END AS x FROM a),
c AS (SELECT *, coalesce((length(x) - length(replace(x, f2, ''))) // length(f2), 0) AS n2 FROM b)
SELECT doc_id, CASE WHEN n2 = 1 THEN replace(x, f2, 'Y') ELSE x END AS text, CAST(CASE WHEN n1 = 1 THEN 1 ELSE 0 END + CASE WHEN n2 = 1 THEN 1 ELSE 0 END AS BIGINT) AS n_records, concat_ws(',', CASE WHEN n1 <> 1 THEN 'first:' || n1 END, CASE WHEN n2 <> 1 THEN 'second:' || n2 END) AS problems FROM c""")
def document_edits(spark: SparkSession, d: str) -> DataFrame:
    """Two corrections of each document, the second one of what the first left."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text")
    ends = F.lit("of\n")
    fixes = docs.select("doc", F.explode(F.array(F.struct(F.lit(1).alias("seq"), F.lit("first").alias("id"), F.coalesce(F.substring("text", 3, 12), F.lit("")).alias("find"), F.concat(F.lit("X"), ends).alias("replace")), F.struct(F.lit(2).alias("seq"), F.lit("second").alias("id"), ends.alias("find"), F.lit("Y").alias("replace")))).alias("e")).select("doc", "e.*")
    got = edits.corrected(docs, fixes)
    return got.select(F.col("doc").alias("doc_id"), "text", F.size("records").cast("bigint").alias("n_records"), F.array_join(F.transform("problems", lambda p: F.concat(p["id"], F.lit(":"), p["n"])), ",").alias("problems"))


@query(r"""
WITH t AS (SELECT doc_id, text, lower(text) AS l, strpos(lower(text), ' the ') AS s FROM documents), e AS (SELECT *, CASE WHEN s > 0 THEN strpos(substr(l, s + 1), ' and ') END AS k FROM t)
SELECT doc_id, CASE WHEN s IS NULL THEN 'no text' WHEN s = 0 THEN 'no salutation' WHEN k = 0 THEN 'no sign-off and no signature that fits' END AS error, CASE WHEN k > 0 THEN s - 1 END AS start, CASE WHEN k > 0 THEN least(s + k + 4 + 10, length(text)) END AS stop FROM e""")
def letter_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Each document as a report with a letter in it, from its first " the " to the first " and " after it."""
    ship(spark)
    found = letters.letter_of(F.col("text"), [" the "], [" and "], [], 10)
    return table(spark, d, "documents").select("doc_id", found.alias("l")).select("doc_id", "l.error", F.when(F.col("l.letter").isNotNull(), F.col("l.start")).cast("bigint").alias("start"), F.col("l.stop").cast("bigint").alias("stop"))


@query("""
SELECT item_id, 'RISK-FY2024-' || substr(sha256('{"accession": "a", "delta_category": "reworded", "fiscal_year": 2024, "item": {"brand": ' || coalesce('"' || brand || '"', 'null') || ', "sizes": [' || coalesce(CAST(size AS VARCHAR), 'null') || ', {"a": true, "name": ' || coalesce('"' || name || '"', 'null') || '}]}, "kind": "risk_delta", "prior_accession": null}'), 1, 8) AS delta_id FROM items""")
def risk_delta_ids(spark: SparkSession, d: str) -> DataFrame:
    """Items as changes in risk factors: their ids, over nested values and without what only measures them."""
    ship(spark)
    item = F.concat(F.lit('{"heading_similarity": 97.5, "sizes": ['), F.coalesce(F.col("size").cast("string"), F.lit("null")), F.lit(', {"name": '), ledger.json_text(F.col("name")), F.lit(', "a": true}], "brand": '), ledger.json_text(F.col("brand")), F.lit("}"))
    return table(spark, d, "items").select("item_id", values.risk_delta_id(F.lit(2024), F.lit("reworded"), item, F.lit("a"), F.lit(None).cast("string")).alias("delta_id"))


@query("""
SELECT click_id, replace(fullkey, '"', '') AS path, trim(CAST(atom AS VARCHAR), '"') AS leaf FROM clicks, json_tree(CASE WHEN json_valid(props) THEN props END) WHERE type NOT IN ('OBJECT', 'ARRAY')""")
def property_leaves(spark: SparkSession, d: str) -> DataFrame:
    """Every scalar in the properties of a click, with its path."""
    got = values.leaves(table(spark, d, "clicks").select("click_id", "props"), "click_id", "props")
    return got.select(F.col("id").alias("click_id"), "path", "leaf")


@query("""
WITH f AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'nothing of this kind was ever written' ELSE substr(text, 1, 50) END AS quote, source FROM documents),
h AS (SELECT f.doc_id, quote, f.source, length(trim(regexp_replace(quote, '\\s+', ' ', 'g'))) >= 25 AND f.doc_id % 3 <> 0 AS verified FROM f)
SELECT doc_id, verified, CASE WHEN verified AND source <> 'src0' THEN 'high' ELSE 'low' END AS confidence, CASE WHEN verified AND doc_id = 10 THEN 'C1' END AS correction,
  CASE WHEN verified AND doc_id = 10 THEN '{"kind": "changed", "n": 10}' ELSE '{"kind": "said", "n": ' || doc_id || '}' END AS value FROM h""")
def ledger_build(spark: SparkSession, d: str) -> DataFrame:
    """Each document as a source and as a fact that quotes it, or doesn't; one of them is corrected."""
    docs = table(spark, d, "documents").select("doc_id", "text", "source").dropDuplicates(["doc_id"])
    key = F.col("doc_id").cast("string")
    raw = docs.select(key.alias("fact"), F.lit("events").alias("field"), F.lit(2022).alias("fiscal_year"), F.concat(F.lit('{"n": '), key, F.lit(', "kind": "said"}')).alias("value"), F.when(F.col("doc_id") % 3 == 0, "nothing of this kind was ever written").otherwise(F.substring("text", 1, 50)).alias("quote"))
    sources = docs.select(key.alias("source_id"), F.lit("8-K").alias("form"), key.alias("accession"), F.col("source").alias("section_key"), F.lit("2022-01-01").alias("filing_date"), "text")
    fixes = spark.createDataFrame([("C1", 1, "events", 2022, "10", '{"kind": "said"}', '{"kind": "changed"}')], "id string, seq int, field string, fiscal_year int, accession string, match string, set string")
    got = build.build(raw, docs.select(key.alias("fact"), F.lit(0).alias("place"), key.alias("source_id")), sources, fixes, ["src0"])
    return got.select(F.col("fact").cast("bigint").alias("doc_id"), "verified", "confidence", "correction", "value")


@query()
def risk_factor_split(spark: SparkSession, d: str) -> DataFrame:
    """The headings of pages as those of risk factors, with their texts."""
    ship(spark)
    nodes = matching.html_nodes(table(spark, d, "pages"), "page_id", "html").withColumnRenamed("page_id", "doc")
    marked = nodes.withColumns({"bold": F.col("heading").isNotNull(), "italic": F.lit(True)})
    return sections.risk_factors(marked)


@query(r"""
WITH d AS (SELECT doc_id AS doc, doc_id % 7 + 600 AS font, regexp_replace(text, '[^ -~\n]', '', 'g') AS plain FROM documents),
c AS (SELECT doc, x, count(*) AS n FROM (SELECT doc, unnest(string_split(plain, '')) AS x FROM d) WHERE x <> chr(10) AND x <> '' GROUP BY ALL),
m AS (SELECT doc, arg_min(ascii(x), (-n, ascii(x))) AS blank FROM c GROUP BY doc),
j AS (SELECT d.doc, plain, font, blank FROM d LEFT JOIN m USING (doc))
SELECT doc, CASE WHEN blank IS NULL THEN plain ELSE array_to_string(list_transform(string_split(plain, ''), lambda x: CASE WHEN x = chr(10) OR x = '' THEN x WHEN ascii(x) - blank + 32 BETWEEN 32 AND 126 THEN chr(CAST(ascii(x) - blank + 32 AS INTEGER)) ELSE chr(65533) || '[cid:' || (ascii(x) + font) || ']' END), '') END AS text,
  CAST(32 - blank - font AS INTEGER) AS shift, CASE WHEN plain IS NOT NULL THEN coalesce(len(list_filter(string_split(plain, ''), lambda x: x <> chr(10) AND x <> '' AND NOT ascii(x) - blank + 32 BETWEEN 32 AND 126)), 0) END AS n_unknown FROM j""")
def glyph_texts(spark: SparkSession, d: str) -> DataFrame:
    """Documents spelled out in glyph ids, each with a font of its own, and read again."""
    ship(spark)
    raw = glyphs.in_glyphs(F.regexp_replace("text", r"[^ -~\n]", ""), F.col("doc_id") % 7 + 600)
    return glyphs.decoded(table(spark, d, "documents").select(F.col("doc_id").alias("doc"), raw.alias("text"))).drop("readable")


@query("""
WITH e AS (SELECT event_id, ['8-K', '10-K', 'DEF 14A', '8-K/A', 'UPLOAD'][event_id % 5 + 1] AS form, ['8-K', 'EX-99.1', 'EX-31.2', 'GRAPHIC', 'DEF 14A', '10-K', 'EX-101.SCH'][event_id % 7 + 1] AS kind, CASE WHEN event_id % 4 <> 0 THEN 'f' || event_id || '.htm' ELSE '' END AS file, CASE WHEN event_id % 3 = 0 THEN ['5.07'] ELSE ['2.02'] END AS items FROM events)
SELECT event_id, replace(replace(form, ' ', '-'), '/', '-') || '_' || replace(replace(replace(upper(kind), ' ', '-'), '/', '-'), '.', '-') || '_whole' AS section_key,
  CASE WHEN starts_with(kind, 'EX-101') OR starts_with(kind, 'GRAPHIC') THEN 'rendering asset' WHEN starts_with(kind, 'EX-31') THEN 'compliance boilerplate' WHEN file = '' THEN 'no filename' ELSE 'kept' END AS attachment,
  form = 'UPLOAD' OR starts_with(kind, replace(form, '/A', '')) OR kind = 'EX-99.1' AS target, starts_with(form, '8-K') AND list_contains(items, '5.07') AS vote,
  'https://archive.test/' || event_id || '/' || replace('00-' || event_id, '-', '') || '/' || file AS url, 2020 + event_id % 6 BETWEEN 2021 AND 2023 AS in_window FROM events JOIN e USING (event_id)""")
def filing_rules(spark: SparkSession, d: str) -> DataFrame:
    """Events as documents of filings: their keys, addresses, and which of them are kept, read, or tell of a vote."""
    k = F.col("event_id")
    among = lambda values: F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))
    form, kind = among(["8-K", "10-K", "DEF 14A", "8-K/A", "UPLOAD"]), among(["8-K", "EX-99.1", "EX-31.2", "GRAPHIC", "DEF 14A", "10-K", "EX-101.SCH"])
    file, items = F.when(k % 4 != 0, F.concat(F.lit("f"), k, F.lit(".htm"))).otherwise(""), F.when(k % 3 == 0, F.array(F.lit("5.07"))).otherwise(F.array(F.lit("2.02")))
    url = filings.archive_url("https://archive.test/{company}/{accession}/{filename}", F.lpad(k.cast("string"), 12, "0"), F.concat(F.lit("00-"), k), file)
    return table(spark, d, "events").select("event_id", filings.section_key(form, kind).alias("section_key"), filings.kept_attachment(kind, file)["reason"].alias("attachment"), filings.is_target(form, kind).alias("target"), filings.is_vote(form, items).alias("vote"), url.alias("url"), filings.in_window(2020 + k % 6, 2021, 2023).alias("in_window"))


@query(r"""
SELECT client_id, regexp_full_match(split_part(coalesce(name, ''), ' ', 1), '[A-Za-z][A-Za-z0-9.\-]{0,9}') AS ticker, coalesce(regexp_matches(email, '(?i)\b(example\.(?:com|org|net)|your[._ ]?name|your[._ ]?email|name@host)\b'), false) AS placeholder,
  CASE WHEN client_id BETWEEN 1 AND 10 THEN ['one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten'][client_id] ELSE CAST(client_id AS VARCHAR) END || '-year' AS span,
  CASE client_id % 3 WHEN 0 THEN 'hit max_tokens (100), response cut off' WHEN 1 THEN CASE WHEN city IS NULL THEN 'no parsed output' END ELSE 'model declined: ' || substr(coalesce(name, ''), 1, 200) END AS problem FROM clients""")
def record_rules(spark: SparkSession, d: str) -> DataFrame:
    """Clients as identities, tickers and recorded answers."""
    k = F.col("client_id")
    stop = F.when(k % 3 == 0, "max_tokens").when(k % 3 == 1, "end_turn").otherwise("refusal")
    return table(spark, d, "clients").select("client_id", filings.is_ticker(F.split_part(F.coalesce("name", F.lit("")), F.lit(" "), F.lit(1))).alias("ticker"), filings.is_placeholder(F.col("email")).alias("placeholder"), filings.span_words(k).alias("span"), filings.record_problem(stop, F.col("city"), F.col("name"), 100).alias("problem"))


def sale_facts(spark: SparkSession, d: str) -> DataFrame:
    """Lines of sales as facts, each third without a source."""
    s, k = table(spark, d, "sale_lines").dropDuplicates(["sale_id", "line_no"]), F.col("sale_id")
    has = lambda c: F.when((k + F.col("line_no")) % 3 != 0, c)
    return s.select(F.concat(F.when(k % 2 == 0, "EVT").otherwise("SEG"), F.lit("-FY"), F.lit(2020) + k % 3, F.lit("-"), k, F.lit("."), F.col("line_no")).alias("id"), F.lit("events").alias("field"), (F.lit(2020) + k % 3).alias("fiscal_year"), F.lit("{}").alias("value"), F.col("flag").alias("quote"), (k % 4 != 0).alias("verified"), F.lit("why").alias("why"), F.when(k % 5 == 0, "low").otherwise("high").alias("confidence"), F.lit("").alias("reasons"), has(F.lit("8-K")).alias("form"), has(F.concat(F.lit("a"), F.coalesce("vendor_id", F.lit(0)))).alias("accession"), F.lit("body").alias("section_key"), F.date_format("shipped_at", "yyyy-MM-dd").alias("filing_date"), "vendor_id")


_SALE_FACTS = """
WITH s AS (SELECT DISTINCT sale_id AS k, line_no FROM sale_lines), f AS (
  SELECT k, CASE WHEN k IS NULL OR line_no IS NULL THEN NULL WHEN k % 2 = 0 THEN 'EVT' ELSE 'SEG' END AS code, 2020 + k % 3 AS fy, CASE WHEN k IS NOT NULL AND line_no IS NOT NULL THEN 'FY' || (2020 + k % 3) END AS year, coalesce((k + line_no) % 3 <> 0, false) AS has FROM s)"""


@query(_SALE_FACTS + """
SELECT code, year, count(*) AS n FROM f GROUP BY ALL""")
def slice_census(spark: SparkSession, d: str) -> DataFrame:
    """How many facts there are of each field and year."""
    return pack.slice_census(sale_facts(spark, d))


@query(_SALE_FACTS + """
SELECT fy AS fiscal_year, count(*) FILTER (has) AS n_kept, count(*) FILTER (NOT has) AS n_excluded, count(*) FILTER (has AND k % 5 = 0) AS n_low, count(*) FILTER (has AND k % 4 = 0) AS n_unverified FROM f GROUP BY 1""")
def pack_counts(spark: SparkSession, d: str) -> DataFrame:
    """The facts of each year that are packed, and those that are left out for want of a source."""
    kept, excluded = pack.packed(sale_facts(spark, d).drop("vendor_id"))
    n = kept.groupBy("fiscal_year").agg(F.count("*").alias("n_kept"), F.count("confidence").alias("n_low"), F.count("quote_unverified").alias("n_unverified"))
    out = n.join(excluded.groupBy("fiscal_year").agg(F.count("*").alias("n_excluded")), "fiscal_year", "full")
    return out.select("fiscal_year", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_kept", "n_excluded", "n_low", "n_unverified")))


@query("""
WITH d AS (SELECT doc_id // 3 AS accession, strpos(lower(text), 'token =') AS m1, strpos(lower(text), 'license') AS m2, strpos(lower(text), '@mail1') AS q, strpos(lower(text), ' the ') AS r FROM documents),
s AS (SELECT accession, count(*) AS n_docs, bool_or(m1 BETWEEN 1 AND 800 OR m2 BETWEEN 1 AND 800) AS hard, bool_or(m1 > 0 OR m2 > 0) AS weak, bool_or(q > 0) AS told, bool_or(r BETWEEN 1 AND 800) AS usual FROM d GROUP BY 1)
SELECT accession, n_docs, CASE WHEN NOT hard AND NOT told AND usual AND NOT weak THEN 'date_only' ELSE 'read' END AS decision,
  CASE WHEN hard AND told THEN 'events,investor_qa' WHEN hard THEN 'events' WHEN told THEN 'investor_qa' WHEN usual AND NOT weak THEN '' ELSE 'events' END AS routes FROM s""")
def triage_filings(spark: SparkSession, d: str) -> DataFrame:
    """Three documents are a filing: which are read, and for what."""
    docs = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 3).alias("accession"), "text")
    patterns = {"secret": ["token =", "license"], "mail": ["@mail1"], "usual": [" the "]}
    got = triage.triage(docs.select("accession", F.lit(2022).alias("fiscal_year")).distinct(), docs, patterns, 800, {"material": ["secret"], "narrative": ["mail"], "routine": ["usual"]})
    return got.select("accession", "n_docs", "decision", F.array_join("routes", ",").alias("routes"))


@query("""
WITH RECURSIVE edges AS (
  SELECT DISTINCT block, a, b FROM (SELECT client_id // 100 AS block, client_id AS a, master_id AS b FROM clients UNION ALL SELECT client_id // 100, master_id, client_id FROM clients) WHERE a IS NOT NULL AND b IS NOT NULL
), reach AS (SELECT * FROM edges UNION SELECT r.block, r.a, e.b FROM reach r JOIN edges e ON e.block = r.block AND e.a = r.b)
SELECT block, a AS node, min(b) AS root FROM reach GROUP BY ALL""")
def components_in_sql(spark: SparkSession, d: str) -> DataFrame:
    """Clients joined by their master within each hundred, by the table function."""
    tables.register(spark)
    edges = table(spark, d, "clients").select(F.floor(F.col("client_id") / 100).alias("block"), F.col("client_id").alias("a"), F.col("master_id").alias("b"))
    return spark.sql("SELECT * FROM components(TABLE({edges}) PARTITION BY block)", edges=edges)


@query("""
SELECT page_id, CAST(length(html) AS BIGINT) AS n_chars FROM pages WHERE html IS NOT NULL AND regexp_matches(html, '<h1[^>]*>\\s*[^\\s<]')""")
def pages_with_headings(spark: SparkSession, d: str) -> DataFrame:
    """Pages that have text in a first heading, by the table function over pages."""
    tables.register(spark)
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"), "html")
    return spark.sql("SELECT p.id AS page_id, CAST(length(p.html) AS BIGINT) AS n_chars FROM {pages} p LEFT SEMI JOIN (SELECT id FROM html_nodes(TABLE({pages}) PARTITION BY id) WHERE heading = 'h1') n ON n.id = p.id", pages=pages)
