"""Values of any shape, as JSON text: their canonical form, keys left out, keys patched, and their leaves through VARIANT.

The canonical form has sorted keys, ", " and ": " between, and all characters as they are but for marks and control characters, so
that a hash over it names what a value says and not how it was written. Text that is no JSON is an error where an id hangs on it
(`canonical_value`), and null where a reader may be tolerant (`leaves`).
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hex digits of an id, of one whose first DIGITS another fact has too, and of the whole hash. Fixed values.
DIGITS, LONGER, WHOLE = 8, 16, 64
#: Levels of nesting that leaves are looked for in.
MOST_LEVELS = 32
#: Keys of a change in risk factors that measure it and don't name it. Fixed values.
MEASURES = ["id", "heading_similarity", "body_similarity", "body_chars", "changed"]


def canonical_text(value: object) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=False)


@F.pandas_udf(T.StringType())
def canonical_value(value: pd.Series) -> pd.Series:
    """The canonical form of JSON text; null for null."""
    return value.map(lambda v: canonical_text(json.loads(v)), na_action="ignore")


@F.pandas_udf(T.StringType())
def without_keys(value: pd.Series, keys: pd.Series) -> pd.Series:
    """The canonical form of a JSON object without some keys of its first level."""
    return pd.Series([None if v is None else canonical_text({k: x for k, x in json.loads(v).items() if k not in set(ks)}) for v, ks in zip(value, keys, strict=True)], dtype=object)


def text(value: Column) -> Column:
    """A string as JSON; null as null."""
    from ledgerline.operators.ledger import json_text

    return json_text(value)


def _digest(prefix: Column, year: Column, fields: dict[str, Column], digits: int = DIGITS) -> Column:
    from ledgerline.operators.ledger import canonical_json

    return F.concat(prefix, F.lit("-FY"), year.cast("string"), F.lit("-"), F.substring(F.sha2(canonical_json(fields), 256), 1, digits))


def value_id(code: Column, field: Column, year: Column, value: Column, form: Column, accession: Column, section: Column, quote: Column, digits: int = DIGITS) -> Column:
    """CODE-FYyear-hex digits of a fact whose value is any JSON object, already canonical."""
    number = F.coalesce(year.cast("string"), F.lit("null"))
    return _digest(code, year, {"field": text(field), "fiscal_year": number, "value": F.coalesce(value, F.lit("null")), "form": text(form), "accession": text(accession), "section_key": text(section), "quote": text(quote)}, digits)


def risk_delta_id(year: Column, category: Column, item: Column, accession: Column, prior: Column) -> Column:
    """RISK-FYyear-8 hex digits of a change in risk factors: the year, the kind of change, the two filings, and all of the item but MEASURES."""
    named = without_keys(item, F.array(*map(F.lit, MEASURES)))
    return _digest(F.lit("RISK"), year, {"kind": F.lit('"risk_delta"'), "fiscal_year": year.cast("string"), "delta_category": text(category), "item": named, "accession": text(accession), "prior_accession": text(prior)})


def leaves(df: DataFrame, ident: str, value: str) -> DataFrame:
    """id, path, kind, leaf of every scalar in the JSON text `value` of each row, at any depth; text that is no JSON has none.

    Level by level: objects and arrays are exploded, scalars are done. `path` is like $.a[0].b, `kind` the type, `leaf` its text.
    """
    spark = df.sparkSession
    now = df.select(F.col(ident).alias("id"), F.lit("$").alias("path"), F.try_parse_json(value).alias("v")).where("v is not null")
    out = spark.createDataFrame([], f"id {df.schema[ident].dataType.simpleString()}, path string, kind string, leaf string")
    for _ in range(MOST_LEVELS):
        kinds = now.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0))
        nested = F.col("kind").isin("OBJECT", "ARRAY")
        out = out.union(kinds.where(~nested).select("id", "path", "kind", F.col("v").cast("string").alias("leaf")))
        inner = kinds.where(nested)
        if not inner.limit(1).count():
            return out
        each = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("id", F.when(F.col("key").isNull(), F.concat("path", F.lit("["), F.col("pos"), F.lit("]"))).otherwise(F.concat_ws(".", "path", "key")).alias("path"), F.col("value").alias("v"))
        now = each
    raise ValueError(f"values nested in more than {MOST_LEVELS} levels")
