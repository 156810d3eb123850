"""The incremental combo: equal to one full merge in any order, repeatable, and nothing stored is shuffled."""
import datetime as dt
import itertools
import random

import pytest

from traitflow import schema as S
from traitflow.operators import combo as CO
from traitflow.operators import dedup as DD
from traitflow.session import staging_path

ORDER = ["pull_a", "pull_b", "pull_c"]


def pulls(spark, seed=1):
    """Three pulls that overlap, with nulls in every content column, copies and both zeros."""
    rng = random.Random(seed)
    pool = [(rng.choice(["p1", "p2", None]), rng.choice([dt.date(2020, 1, 1), dt.date(2020, 1, 2), None]), rng.choice(["t", "u", None]),
             rng.choice([1.5, 0.0, -0.0, float("nan"), None]), rng.choice(["g/L", None])) for _ in range(90)]
    out = []
    for name in ORDER:
        rows = [r + (name, rng.choice(S.SOURCE_OPTIONS)) for r in rng.choices(pool, k=80)]
        out.append(spark.createDataFrame(rows, S.COMBO_SCHEMA))
    return out


def bag(df):
    return sorted(tuple("0.0" if isinstance(v, float) and v == 0 else str(v) for v in r) for r in df.select(*S.COMBO_COLUMNS).collect())


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_store_equals_full_merge(spark, order):
    p = pulls(spark)
    store = CO.ComboStore(spark, staging_path(spark, "combo"), ORDER, buckets=4)
    for k in order:
        store.add(p[k])
    want = bag(DD.merge(p, ORDER))
    assert bag(store.read()) == want
    rows = store.rows().count()
    for k in order:                       # again, as after a run that stopped
        store.add(p[k])
    assert store.rows().count() == rows and bag(store.read()) == want
    small = store.compacted(staging_path(spark, "combo-small"))
    assert bag(small.read()) == want and small.rows().count() == len(want)
    small.forget()
    store.forget()


def test_a_later_session_takes_the_store_up(spark):
    p, path = pulls(spark, 2), staging_path(spark, "combo")
    first = CO.ComboStore(spark, path, ORDER[:2], buckets=3)
    first.add(p[0])
    first.add(p[1])
    first.forget()                        # another session knows the files only
    again = CO.ComboStore(spark.newSession(), path, ORDER, buckets=99)
    assert again.buckets == 3
    again.add(p[2])
    assert bag(again.read()) == bag(DD.merge(p, ORDER))
    with pytest.raises(ValueError, match="does not continue"):
        CO.ComboStore(spark, path, ORDER[::-1])
    again.forget()


@pytest.mark.parametrize("buckets,partitions", [(4, 8), (16, 8), (8, 200)])
def test_only_the_pull_is_shuffled(spark, buckets, partitions):
    p = pulls(spark, 3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(before, (partitions, -1, "false")):
        spark.conf.set(k, v)
    try:
        store = CO.ComboStore(spark, staging_path(spark, "combo"), ORDER, buckets)
        store.add(p[0])
        plan = store.missing(p[1])._jdf.queryExecution().executedPlan()
        joins = [plan.apply(i) for i in range(40) if plan.apply(i) is not None and plan.apply(i).nodeName() == "SortMergeJoin"]
        assert len(joins) == 1
        old = joins[0].children().apply(1).toString()
        assert "Exchange" not in old and f"SelectedBucketsCount: {buckets} out of {buckets}" in old, old
        assert "Exchange" in joins[0].children().apply(0).toString()
        read = store.read()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in read and "HashAggregate" in read, read
        store.forget()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
