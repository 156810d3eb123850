import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from traitflow.operators import dedup as DD
from traitflow.operators import stats as ST
from traitflow.operators import tiles as TI
from traitflow.operators import traits as TR
from traitflow.plans import pipeline as P

D = dt.date


def test_units_hba1c_and_unmatched(spark):
    traits = spark.createDataFrame([("HbA1c", "mmol/mol", 20.0, 195.0), ("#Off", "g/L", 0.0, 1.0),
                                    ("Alb", "g/L", 10.0, 80.0)], "trait string, target_units string, min double, max double")
    aliases = spark.createDataFrame([("HbA1c", "A1c"), ("Alb", "Albumin")], "trait string, alias string")
    units = spark.createDataFrame([("g/dL", "g/L", 10.0), ("g/L", "g/L", 1.0), ("%", "mmol/mol", 1.0),
                                   ("#g/L", "g/L", 1.0)], "result_value_units string, target string, multiplication_factor double")
    rows = [("p", D(2020, 1, 1), "A1c", 6.0, u, "x", "primary_care") for u in ["%", "% total Hb", "%Hb", "per cent"]]
    rows += [("p", D(2020, 1, 1), "Albumin", 4.0, "g/dL", "x", "primary_care"),
             ("p", D(2020, 1, 1), "Albumin", 45.0, "kg/m^2", "x", "primary_care"),   # unmatched unit: unconverted
             ("p", D(2020, 1, 1), "Albumin", 45.0, None, "x", "primary_care"),       # null unit dropped
             ("p", D(2020, 1, 1), "#Off", 0.5, "g/L", "x", "primary_care")]          # disabled row never matches
    combo = spark.createDataFrame(rows, "pseudo_nhs_number string, test_date date, original_term string, result double, "
                                        "result_value_units string, provenance string, source string")
    got = P.ranged_readings(combo, traits, aliases, units).select(
        "result_value_units", "final", "range_position", "unit_matched").collect()
    by_unit = {r[0]: r for r in got}
    assert len(got) == 6
    for u in ["%", "% total Hb", "%Hb", "per cent"]:
        assert abs(by_unit[u][1] - (10.93 * 6.0 - 23.5)) < 1e-12 and by_unit[u][2] == "ok"
    assert by_unit["g/dL"][1] == 40.0 and by_unit["g/dL"][3]
    assert by_unit["kg/m^2"][1] == 45.0 and not by_unit["kg/m^2"][3]


def test_tile_dedup_keeps_earliest_per_tile(spark):
    rows = [("p", "T", 5.0, D(1970, 1, 1)), ("p", "T", 5.0, D(1970, 1, 11)),    # same tile -> one
            ("p", "T", 5.0, D(1970, 1, 12)),                                      # next tile
            ("p", "T", 6.0, D(1970, 1, 3)),                                       # other value
            ("p", "T", 5.0, D(1969, 12, 25)), ("p", "T", 5.0, D(1969, 12, 21)),   # before 1970, same tile
            ("p", "T", 5.0, D(1969, 12, 20))]
    df = spark.createDataFrame(rows, "pseudo_nhs_number string, trait string, final double, test_date date")
    got = sorted((r["value"], r["date"]) for r in TI.tile_dedup_11d(df, dependent=()).collect())
    assert got == [(5.0, D(1969, 12, 20)), (5.0, D(1969, 12, 21)), (5.0, D(1970, 1, 1)), (5.0, D(1970, 1, 12)),
                   (6.0, D(1970, 1, 3))]
    again = TI.tile_dedup_11d(TI.tile_dedup_11d(df, dependent=()).withColumnRenamed("value", "final")
                              .withColumnRenamed("date", "test_date"), dependent=())
    assert again.count() == 5   # idempotent


def test_exact_median_matches_statistics(spark):
    rnd = random.Random(3)
    rows = [(g, float(rnd.randint(0, 30))) for g in range(20) for _ in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r[0]: r[1] for r in ST.exact_median(df, ["g"], "v").collect()}
    for g in range(20):
        vals = [v for gg, v in rows if gg == g]
        assert got[g] == statistics.median(vals)
    # unchanged under repartitioning
    got2 = {r[0]: r[1] for r in ST.exact_median(df.repartition(7), ["g"], "v").collect()}
    assert got2 == got


def test_banded_median_is_exact(spark):
    rnd = random.Random(9)
    rows = []
    for g in range(12):
        size = rnd.choice([1, 2, 3, 10, 400, 3000])
        spread = rnd.choice([3, 50, 10_000])
        rows += [(g, float(rnd.randint(0, spread)) / 4) for _ in range(size)]
    df = spark.createDataFrame(rows, "g int, v double")
    want = {g: statistics.median([v for gg, v in rows if gg == g]) for g in range(12)}
    for acc in (10_000, 20, 4):     # 4: brackets too tight for some groups -> exact fallback path
        got = {r[0]: r[1] for r in ST.exact_median(df, ["g"], "v", band_accuracy=acc).collect()}
        assert got == want, acc
    ext = ST.exact_median(df, ["g"], "v", extremes={"min": "lo", "max": "hi", "n": "n"}, band_accuracy=50)
    for r in ext.collect():
        vals = [v for gg, v in rows if gg == r["g"]]
        assert (r["lo"], r["hi"], r["n"]) == (min(vals), max(vals), len(vals))


def test_per_individual_stats_earliest_latest_ties(spark):
    rows = [("p", "T", "ok", 3.0, D(2020, 1, 1)), ("p", "T", "ok", 1.0, D(2020, 1, 1)),
            ("p", "T", "ok", 7.0, D(2020, 2, 1)), ("p", "T", "ok", 9.0, D(2020, 2, 1))]
    df = spark.createDataFrame(rows, "pseudo_nhs_number string, trait string, minmax_outlier string, value double, date date")
    r = ST.per_individual_stats(df).first()
    assert (r["median"], r["mean"], r["min"], r["max"], r["earliest"], r["latest"], r["n"]) == (5.0, 5.0, 1.0, 9.0, 1.0, 9.0, 4)


def test_dedup_readings_survivor_and_idempotence(spark):
    base = ("p", D(2020, 1, 1), "T", 1.0, "g/L")
    rows = [base + ("b", "primary_care"), base + ("a", "secondary_care"),
            ("q", D(2020, 1, 1), "T", 1.0, None, "b", "primary_care"),
            ("q", D(2020, 1, 1), "T", 1.0, None, "a", "secondary_care"),
            ("q", D(2020, 1, 1), "T", 1.0, None, "a", "primary_care")]
    df = spark.createDataFrame(rows, "pseudo_nhs_number string, test_date date, original_term string, result double, "
                                     "result_value_units string, provenance string, source string")
    out = DD.dedup_readings(df, ["a", "b"])
    got = sorted((r[0], r[5], r[6]) for r in out.collect())
    assert got == [("p", "a", "secondary_care"), ("q", "a", "primary_care")]   # null units group together
    assert DD.dedup_readings(out, ["a", "b"]).count() == 2
    import pytest
    with pytest.raises(Exception):   # provenance outside the closed set fails the job
        DD.dedup_readings(df, ["b"]).collect()


def test_people_age_filters(spark):
    from traitflow.operators import filters as FL
    rows = [("p", D(2016, 1, 1), D(2000, 1, 1)), ("p", D(2015, 12, 29), D(2000, 1, 1)),
            ("p", D(1999, 1, 1), D(2000, 1, 1)), ("p", D(2030, 1, 1), D(2000, 1, 1)), ("q", D(2020, 1, 1), None)]
    df = spark.createDataFrame(rows, "pseudo_nhs_number string, test_date date, dob date") \
        .withColumn("age_at_test", F.datediff("test_date", "dob") / 365.25)
    kept = FL.filter_min_age(FL.filter_plausible_dates(df, "2025-01-01"))
    assert [r["test_date"] for r in kept.collect()] == [D(2016, 1, 1)]
