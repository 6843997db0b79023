"""The text functions under their names in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerline.functions import quotes, text
from ledgerline.sources.shipping import ship


def register(spark: SparkSession) -> None:
    """canon_text, token_sort_ratio, token_set_ratio and verify_quote, for spark.sql of this session."""
    ship(spark)
    for f in (text.canon_text, text.token_sort_ratio, text.token_set_ratio, quotes.verify_quote):
        spark.udf.register(f.__name__, f)
