"""A training-corpus pipeline over `documents`: language ID, n-gram Jaccard join, substring dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it wrote, and returns a DataFrame. All but
the last return the columns of `documents`; other columns, whatever their names, are left out.

Defined cases, for every stage: an empty table gives an empty one; repeated rows are each kept or dropped alike, but for those
that the stage itself removes; very long texts are read whole. Null and empty texts go at language ID (they have no letter), and
stay in the other stages. Rows with a null doc_id are never learned from, grouped or cut; they are searched for benchmark items and encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, langid, ngram_join, substring_dedup
from ledgerline.llm.common import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told (`und`: no letter); a missing label is filled with the prediction.

    Where no document has a label to learn from, documents with a letter stay as they are.
    """
    samples = langid.learn(docs)
    if not any(c.isalpha() for text in samples.values() for c in text):
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    found = langid.label(docs, samples, COLUMNS)
    return found.where(F.col("lang_pred") != langid.UNKNOWN).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates, with all its rows. Documents without words stay."""
    return ngram_join.keep_representatives(docs.select(*COLUMNS))


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that a document with a smaller id has too; documents stay (with an empty text, if all of it goes), n_chars follows the text."""
    cut = substring_dedup.remove_repeats(docs, carry=["lang", "source", "n_chars"])
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, and digests of the ids and of the decoded text."""
    path = public_tokenizers.path("word_bpe_49k.json")
    both = bpe.encode_decode(docs, path)
    return both.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", dedup_substrings),
    ("benchmark_decontamination", decontamination),
    ("bpe", bpe_codes),
]

#: Cross-parsing, content-defined chunks and BPE are not expressible in SQL; the tests hold each stage's output against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, name)
    return docs
