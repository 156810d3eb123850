"""Registered queries against their DuckDB SQL on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from traitflow.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_registered():
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in E.queries()) == 1
    assert "pipeline" in E.queries() and set(registry.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[key](spark, SF)
    res = con.execute(registry.ORACLE[key])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)

    def bag(columns, rows):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return Counter(tuple(float(f"{r[i]:.9g}") if isinstance(r[i], float) and not math.isnan(r[i]) else r[i] for i in order) for r in rows)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(names, res.fetchall())
