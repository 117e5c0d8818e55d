"""Each catalogue query equals its DuckDB oracle on the sf0.001 tables."""

import hashlib
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from apiary.plans import catalog
from support import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df.to_dict("records"))
    return len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hive", "n", "total", "average"]


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _digest(got) == _digest(want)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
