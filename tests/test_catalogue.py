"""Every query with SQL gives the rows that DuckDB gives on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from ledgerline.operators import attribution
from ledgerline.plans import catalogue, evidence, reports, tracing  # noqa: F401  registers its queries

FOLDER = Path("/root/testdata/sf0.001")


def rows(df):
    norm = lambda v: None if pd.isna(v) else f"{float(v):.6f}" if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)[:19].removesuffix(" 00:00:00")
    cols = sorted(df.columns)
    return cols, sorted([tuple(norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)], key=str)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, str(FOLDER)).toPandas()) == rows(duck.execute(catalogue.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, str(FOLDER)).toPandas().shape[1] > 0  # executed in full


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("most", [1_000_000, 8])
def test_short_quotations(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(attribution.first_containing, "__defaults__", (most,))
    docs = [(1, "nothing here"), (2, "alpha beta gamma delta epsilon zeta"), (3, "so alphabet and gammas end"), (4, None)]
    quotes = [(1, "gamma"), (2, "beta gamma"), (3, "beta gamma delta"), (4, "alpha beta gamma delt"), (5, "pha beta gamma delta eps"), (6, ""), (7, "absent"), (8, None), (9, "gamma"), (10, "bet and gam"), (11, "gamma  delta")]
    duck = duckdb.connect()
    for name, rows_, key in (("documents", docs, "doc_id"), ("benchmark", quotes, "item_id")):
        spark.createDataFrame(rows_, f"{key} bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        duck.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert rows(catalogue.QUERIES["quote_containment"](spark, str(tmp_path)).toPandas()) == rows(duck.execute(catalogue.ORACLE_SQL["quote_containment"]).df())
