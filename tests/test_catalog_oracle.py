"""Every registered query against its DuckDB SQL on the smallest driver tables."""
import datetime
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle_sql():
    assert set(E.catalog.QUERIES) == set(E.catalog.ORACLE) and set(E.catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.catalog.QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, rows) == _bag(dcols, res.fetchall())


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.count() > 0
