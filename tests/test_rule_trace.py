"""Readings with the rule that drops them."""
import random

from pyspark.sql import functions as F

from traitflow.operators import audit as AU



def rules():
    return [("positive", F.col("a") > 0), ("small", F.col("a") < 8), ("named", F.col("b") != "x")]


def test_trace_equals_brute_force_and_step_counts(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, -1, 0, 3, 5, 9]), rng.choice([None, "x", "y"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, i int")
    plain = [lambda a, b: a is not None and a > 0, lambda a, b: a is not None and a < 8, lambda a, b: b is not None and b != "x"]
    want = {i: next((k for k, p in enumerate(plain, 1) if not p(a, b)), 0) for a, b, i in rows}
    trace = AU.traced(df, rules())
    assert {r.i: r.rule for r in trace.collect()} == want
    assert sorted(map(tuple, AU.rule_counts(trace, rules()).collect())) == sorted(map(tuple, AU.audit_steps(df, rules()).collect()))
    bad = AU.quarantine(trace, rules()).collect()
    assert {r.i: r.reason for r in bad} == {i: rules()[k - 1][0] for i, k in want.items() if k}


def test_one_aggregation_and_no_rows(spark):
    df = spark.createDataFrame([], "a int, b string")
    counts = AU.rule_counts(AU.traced(df, rules()), rules())
    assert [tuple(r) for r in counts.collect()] == [(1, "positive", 0, 0, None), (2, "small", 0, 0, None), (3, "named", 0, 0, None)]
    plan = AU.rule_counts(AU.traced(spark.range(9).selectExpr("cast(id as int) a", "'y' b"), rules()), rules())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Range") == 1
