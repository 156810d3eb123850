"""Dyadic interval index and the m:1 guard of the region join, against brute force."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from traitflow.operators import regions as RG

SEG = "pseudo_nhs_number string, start_date date, end_date date, region_types array<string>"
PTS = "pseudo_nhs_number string, test_date date, k int"


def day(n):
    return dt.date(1970, 1, 1) + dt.timedelta(days=n)


def random_segments(rng, overlapping):
    """Segments of one day to a hundred years, also before 1970."""
    out = []
    for p in ("a", "b", "c", None):
        at = -40_000
        while at < 60_000:
            length = rng.choice([0, 1, 3, 31, 32, 33, 64, 255, 256, 257, 300, 5_000, 36_525])
            out.append((p, day(at), day(at + length), [p or "n", str(at)]))
            at += rng.randint(1, 9_000) if overlapping else length + rng.choice([0, 0, 1, 40, 700])
            if len(out) % 60 == 59:
                break
    return out


@pytest.mark.parametrize("overlapping", [True, False])
def test_range_join_equals_brute_force(spark, overlapping):
    rng = random.Random(overlapping)
    segs = random_segments(rng, overlapping)
    edges = [s for _, a, b, _ in segs for s in (a, b, a - dt.timedelta(1), b - dt.timedelta(1))]
    points = [(p, d, i) for i, d in enumerate(rng.sample(edges, min(200, len(edges))) + [day(rng.randint(-45_000, 70_000)) for _ in range(200)] + [None]) for p in ("a", "b", None)]
    got = RG.range_join_regions(spark.createDataFrame(points, PTS), spark.createDataFrame(segs, SEG))
    want = sorted((p, k, a, tuple(r)) for p, d, k in points for q, a, b, r in segs if p is not None and p == q and d is not None and a <= d < b)
    assert sorted((r.pseudo_nhs_number, r.k, r.start_date, tuple(r.region_types)) for r in got.collect()) == want
    assert len(want) > 100
    assert got.columns == ["pseudo_nhs_number", "test_date", "k", "start_date", "end_date", "region_types"]


def test_rows_of_a_segment_grow_with_the_logarithm_of_its_length(spark):
    for days in (1, 200, 36_525, 2_900_000):
        s = spark.createDataFrame([("p", day(17), day(17 + days), ["APC"])], SEG)
        nodes = RG.interval_nodes(s).select("_level", "_node").collect()
        assert len(nodes) <= RG.SHORT_BUCKETS + 2 * max(0, (days // 32).bit_length()), days
        covered = sorted((n._node << n._level, (n._node + 1) << n._level) for n in nodes)
        assert all(x[1] == y[0] for x, y in zip(covered, covered[1:]))
        assert covered[0][0] == 17 // 32 and covered[-1][1] == (16 + days) // 32 + 1


@pytest.mark.parametrize("via", [False, True])
def test_every_reading_stays_once(spark, via):
    rng = random.Random(4)
    segs = random_segments(rng, False)
    points = [(rng.choice(["a", "b", "z", None]), day(rng.randint(-45_000, 70_000)), k) for k in range(300)] + [("a", None, 300)]
    rows = RG.add_region_types(spark.createDataFrame(points, PTS), spark.createDataFrame(segs, SEG), via_lookup=via).collect()
    want = {k: next((tuple(r) for q, a, b, r in segs if p is not None and q == p and d is not None and a <= d < b), None) for p, d, k in points}
    assert {r.k: tuple(r.region_types) if r.region_types is not None else None for r in rows} == want and len(rows) == len(points)


@pytest.mark.parametrize("via", [False, True])
@pytest.mark.parametrize("lengths", [(5, 5), (5, 4_000), (4_000, 4_000)])
def test_a_reading_in_two_segments_fails_the_job(spark, via, lengths):
    segs = spark.createDataFrame([("p", day(100), day(100 + lengths[0]), ["APC"]), ("p", day(103), day(103 + lengths[1]), ["buffer_after"])], SEG)
    safe = spark.createDataFrame([("p", day(101), 1), ("q", day(104), 2)], PTS)
    assert {r.k: r.region_types for r in RG.add_region_types(safe, segs, via_lookup=via).collect()} == {1: ["APC"], 2: None}
    with pytest.raises(Exception, match="several segments hold one reading: p 1970-04-15"):
        RG.add_region_types(safe.union(spark.createDataFrame([("p", day(104), 3)], PTS)), segs, via_lookup=via).collect()


def test_no_second_pass_over_the_readings(spark):
    """The guard reads the readings and the segments once each."""
    pts = spark.range(10).select(F.lit("p").alias("pseudo_nhs_number"), F.lit(day(3)).alias("test_date"))
    seg = spark.createDataFrame([("p", day(1), day(2), ["APC"])], SEG)
    plan = RG.add_region_types(pts, seg)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1
