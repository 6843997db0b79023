"""The registered queries of this subpackage. Each reads whole tables and returns its operator's full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, html_extract, langid, ngram_join, phrases, pii, quality, rolling, substring_dedup, token_counts, token_store, url_filter
from ledgerline.llm.common import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    both = bpe.encode_decode(table(spark, sf_dir, "documents"), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.learn(docs))
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    token_store.write_store(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_store.read_store(spark, folder)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_features(table(spark, sf_dir, "documents"), rolling.event_time())


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.learn(docs))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_quality, op3_url_filter, op4_html_extract, op5_substring_dedup, op6_langid, op7_token_counts, op8_token_store, op9_decontaminate, op10_ngram_join, op11_rolling, op12_phrases, op13_pii, pipeline)
}

OP3_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), named AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM hosts
), ruled AS (
  SELECT *, CASE
    WHEN '.' || host LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN '.' || host LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule FROM named
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN starts_with(path, '/') AND (host LIKE '%casino%' OR host LIKE '%pills%' OR host LIKE '%spam%' OR host LIKE '%free-bets%' OR host LIKE '%ads-track%') THEN 'block'
  WHEN host || path LIKE '%.exe' OR host || path LIKE '%.zip' THEN 'block'
  ELSE 'allow' END AS verdict FROM ruled
"""

#: crc32 by its definition: the polynomial's reversed bits, eight shifts (-1) after each byte.
OP11_SQL = r"""
WITH steps AS (
  SELECT row_number() OVER () AS row, doc_id, source, lang, length(text) AS chars,
    [4294967295::BIGINT] || flatten(list_transform(regexp_extract_all(doc_id::VARCHAR, '.'), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS x
  FROM documents
), timed AS (
  SELECT *, 60 * floor((doc_id + xor(list_reduce(x, lambda c, y: CASE WHEN y >= 0 THEN xor(c, y) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 4000)::DECIMAL(18, 0) / 6)::BIGINT AS event_s FROM steps
), asked AS (
  SELECT row, doc_id, source, event_s, w.window_s FROM timed, (VALUES (3600::BIGINT), (21600::BIGINT)) AS w(window_s)
), found AS (
  SELECT a.row, a.doc_id, a.window_s, a.event_s, count(t.row) AS n_events, coalesce(sum(t.chars), 0)::BIGINT AS sum_chars, count(DISTINCT t.lang) AS n_langs,
    list_sort(list(t.chars) FILTER (WHERE t.chars IS NOT NULL)) AS chars
  FROM asked a LEFT JOIN timed t ON t.source IS NOT DISTINCT FROM a.source AND t.event_s >= a.event_s - a.window_s AND t.event_s < a.event_s
  GROUP BY ALL
)
SELECT doc_id, window_s, event_s, n_events, sum_chars, n_langs, chars[(len(chars) + 1) // 2]::BIGINT AS median_chars, chars[(75 * len(chars) + 99) // 100]::BIGINT AS high_chars FROM found
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM worded GROUP BY lang
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: words[i:i + k - 1])) AS phrase FROM worded, range(1, 5) AS g(k)
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), candidates AS (
  SELECT lang, k, phrase, f AS a FROM counts WHERE k > 1 AND f >= 30
), parts AS (
  SELECT lang, a, unnest(list_distinct(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: phrase[i:i + m - 1]))))) AS phrase FROM candidates WHERE k > 2
), dead AS (
  SELECT c.lang, c.phrase FROM candidates c JOIN parts p ON p.lang = c.lang AND p.phrase = c.phrase WHERE 100 * p.a >= 80 * c.a GROUP BY ALL
), alive AS (
  SELECT * FROM candidates ANTI JOIN dead USING (lang, phrase)
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut.k AS cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM alive c JOIN range(1, 4) AS cut(k) ON cut.k < c.k
  JOIN counts x ON x.lang = c.lang AND x.phrase = c.phrase[1:cut.k] JOIN counts y ON y.lang = c.lang AND y.phrase = c.phrase[cut.k + 1:c.k]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank FROM lowest
)
SELECT lang, rank, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {"op3_url_filter": OP3_SQL, "op11_rolling": OP11_SQL, "op12_phrases": OP12_SQL}
