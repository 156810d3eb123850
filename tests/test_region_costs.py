"""The levels that a range join's points look at come from one pass over the intervals; stays are parsed once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from traitflow.operators import regions as RG
from traitflow.plans import bindings as B

SEG = "pseudo_nhs_number string, start_date date, end_date date, region_types array<string>"
DAY0 = dt.date(1970, 1, 1)


def segment(person, start, length):
    return (person, DAY0 + dt.timedelta(start), DAY0 + dt.timedelta(start + length), ["APC"])


@pytest.mark.parametrize("lengths", [[], [1], [300], [1, 200, 300, 36_525, 2_900_000]])
def test_levels_are_those_of_the_nodes(spark, lengths):
    segs = spark.createDataFrame([segment("p", -17 - i, n) for i, n in enumerate(lengths)] + [segment("p", 5, 0)], SEG)
    nodes = {r._level for r in RG.interval_nodes(segs).select("_level").collect()}
    used = RG.used_levels(segs)
    assert set(used.first()._used or []) == nodes
    assert "Generate" not in used._jdf.queryExecution().optimizedPlan().toString()


def test_levels_of_distinct_intervals_need_no_distinct(spark, tmp_path):
    """The distinct stays were computed and exploded twice, once for the levels that they use."""
    rows = [segment(p, 40 * i, 3 + i)[:3] for i in range(30) for p in ("a", "b", None)]
    spark.createDataFrame(rows + rows, "pseudo_nhs_number string, start_date date, end_date date").write.parquet(f"{tmp_path}/s")
    segs = spark.read.parquet(f"{tmp_path}/s").distinct().withColumn("region_types", F.array(F.lit("APC")))
    used = RG.used_levels(segs)
    assert used.first()._used == [0]
    assert used._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    points = spark.read.parquet(f"{tmp_path}/s").select("pseudo_nhs_number", F.col("start_date").alias("test_date")).distinct()
    assert RG.range_join_regions(points, segs).count() == 60


def test_a_stay_date_is_parsed_once(spark, tmp_path):
    """Filters on the dates went below the distinct and parsed them again, each of them."""
    rows = [(k, k % 7 or None, dt.datetime(1995, 1, 1) + dt.timedelta(k)) for k in range(120)]
    spark.createDataFrame(rows + rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    stays = B.stays(spark, str(tmp_path))
    start, end = F.col("hospital_admission_datetime"), F.col("hospital_discharge_datetime")
    used = stays.filter(end.isNotNull() & (end > start) & (end.cast("date") > start.cast("date"))).select("pseudo_nhs_number", start.cast("date"), end.cast("date"))
    assert used._jdf.queryExecution().optimizedPlan().toString().lower().count("gettimestamp") == 2
    got = sorted(map(str, stays.collect()))
    assert len(got) == 120 and stays.columns == ["pseudo_nhs_number", "hospital_admission_datetime", "hospital_discharge_datetime", "hospital_stay_type"]
    assert stays.filter(end.isNull()).count() == sum(k % 53 == 0 for k in range(120))
    assert stays.filter(end.cast("date") != F.date_add(start.cast("date"), F.datediff(end, start))).isEmpty()
