"""Stored sketches against exact counts and brute force."""
import random
from collections import defaultdict
from statistics import median

from pyspark.sql import functions as F

from traitflow.operators import audit as AU
from traitflow.operators import sketches as SK


def rules():
    return [("positive", F.col("v") > 0), ("small", F.col("v") < 50)]


def test_people_by_step_and_overlaps(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["p%d" % rng.randrange(300), None]), rng.choice("abc"), rng.randrange(-20, 90)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "pseudo_nhs_number string, provenance string, v int").repartition(5)
    trace = AU.traced(df, rules())
    sketches = SK.people_sketches(trace, rules())
    left = [lambda v: True, lambda v: v > 0, lambda v: 0 < v < 50]
    want = {i: len({p for p, _, v in rows if p and keep(v)}) for i, keep in enumerate(left)}
    assert {r.step: r.n_people for r in SK.people_counts(sketches).collect()} == want
    assert {r.step: r.n_people for r in SK.exact_people_counts(trace, rules()).collect()} == want
    per = {s: {p for p, q, v in rows if p and q == s and 0 < v < 50} for s in "abc"}
    got = {(r.first, r.second): r.n_people for r in SK.people_overlaps(sketches, 2).collect()}
    assert got == {(x, y): len(per[x] & per[y]) for x in "abc" for y in "abc" if x < y}


def test_error_beyond_the_entries_is_as_stated(spark):
    n = 400_000
    df = spark.range(n).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("pseudo_nhs_number"), F.lit("a").alias("provenance"), F.lit(1).alias("v"))
    got = SK.people_counts(SK.people_sketches(AU.traced(df, rules()), rules())).filter("step = 0").first().n_people
    assert abs(got - n) <= 5 * SK.relative_error() * n and SK.relative_error() < 0.004


def test_medians_from_merged_sketches_are_exact(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice(["in", "all"]), t, f"p{rng.randrange(50)}", None if rng.random() < .05 else f(rng)) for t, f in
            (("smooth", lambda r: r.gauss(5, 2)), ("steps", lambda r: float(r.randrange(4))), ("one", lambda r: 7.0)) for _ in range(3000)]
    rows += [("all", "few", "p1", 1.0), ("all", "few", "p2", 4.0), ("all", "none", "p1", None)]
    schema = "setting string, trait string, pseudo_nhs_number string, value double"
    df = spark.createDataFrame(rows, schema)
    groups = defaultdict(list)
    for s, t, _, v in rows:
        if v is not None:
            groups[s, t].append(v)
    stored = SK.value_sketches(df.filter("pseudo_nhs_number < 'p3'")).unionByName(SK.value_sketches(df.filter("pseudo_nhs_number >= 'p3'")))
    for bracket in (SK.BRACKET, 0.0):           # without a bracket most groups take the second way
        monkeypatch.setattr(SK, "BRACKET", bracket)
        merged = SK.merged_values(stored)
        got = {(r.setting, r.trait): r for r in SK.summary(merged, SK.exact_medians(df, merged)).collect()}
        assert set(got) == set(groups)
        for k, v in groups.items():
            assert abs(got[k].median - median(v)) < 1e-12 and got[k].n == len(v) and got[k].min == min(v) and got[k].max == max(v)
            assert abs(got[k].mean - sum(v) / len(v)) < 1e-9
            assert got[k].n_people == len({p for s, t, p, x in rows if (s, t) == k and x is not None})
