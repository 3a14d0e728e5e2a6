"""Driver contract and a DuckDB oracle pass over the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from sievery.plans.catalog import QUERIES
from sievery.plans.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["channel", "category", "n_seen", "n_kept"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v == int(v) else round(v, 6)
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(k for k in ORACLE if not k.startswith("stream")))
def test_query_matches_oracle(spark, duck, key):
    got = _rows(E.queries()[key](spark, SMALL).toPandas())
    want = _rows(duck.execute(E.oracle_sql()[key]).df())
    assert got == want
