import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from traitflow.functions import scalars as X


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_number_parsing_never_trims_or_accepts_suffixes(spark):
    vals = ["<5", "> 5", "Less than 5", " 5", "5 ", "5d", "NA", ".", "1:32", "92-99", "5%", "3.6.1", "1,234",
            None, "", "5", "-2.5", ".5", "5.", "1e3"]
    got = col_values(spark, vals, X.parse_number_lenient)
    assert got == [None] * 15 + [5.0, -2.5, 0.5, 5.0, 1000.0]


def test_strict_number_parse_fails_the_job(spark):
    df = spark.createDataFrame([("5",), ("5d",)], "v string")
    with pytest.raises(Exception):
        df.select(X.parse_number_strict("v")).collect()
    ok = spark.createDataFrame([("5",), (None,)], "v string").select(X.parse_number_strict("v")).collect()
    assert [r[0] for r in ok] == [5.0, None]


def test_replace_first_only_first_match(spark):
    got = col_values(spark, ["a1b2c3", "none"], lambda c: X.replace_first(c, "[0-9]", "#"))
    assert got == ["a#b2c3", "none"]
    got = col_values(spark, ["x3.6.1y3.6.1"], lambda c: X.replace_first(c, r"3\.6\.1", "36.1"))
    assert got == ["x36.1y3.6.1"]
    got = col_values(spark, ["{12}"], lambda c: X.replace_first(c, r"^\{(.*?)\}$", "$1"))
    assert got == ["12"]


def test_prefix_chain_strips_once_in_order(spark):
    got = col_values(spark, ["<<5", "< 5", " <5", "><5"], lambda c: X.strip_prefix_chain(c, ["<", ">", " "]))
    assert got == ["<5", "5", "<5", "<5"]
    got = col_values(spark, ["5cm%", "5%cm"], lambda c: X.strip_suffix_chain(c, ["%", "cm"]))
    assert got == ["5", "5%"]        # "%" then "cm": order matters


def test_literal_helpers_escape_regex(spark):
    got = col_values(spark, ["a.b.c", "x$y"], lambda c: X.replace_all_literal(c, "."))
    assert got == ["abc", "x$y"]
    got = col_values(spark, ["(5)", "*{6}", "{7}", "(8"], X.unwrap_brackets)
    assert got == ["5", "6", "7", "(8"]


def test_round_to_day_rounds_late_times_up(spark):
    df = spark.createDataFrame([("2022-01-05 23:59:59",), ("2022-01-05 00:00:00",), ("2022-01-05 12:00:00",),
                                ("2022-01-05 11:59:59",)], "t string")
    got = [r[0] for r in df.select(X.round_to_day(F.to_timestamp_ntz("t"))).collect()]
    assert got == [dt.date(2022, 1, 6), dt.date(2022, 1, 5), dt.date(2022, 1, 6), dt.date(2022, 1, 5)]


def test_tile_index_epoch_aligned_and_before_1970(spark):
    df = spark.createDataFrame([(dt.date(1970, 1, 1),), (dt.date(1970, 1, 11),), (dt.date(1970, 1, 12),),
                                (dt.date(1969, 12, 31),), (dt.date(1969, 12, 21),), (dt.date(1969, 12, 20),)], "d date")
    assert [r[0] for r in df.select(X.tile_index("d")).collect()] == [0, 0, 1, -1, -1, -2]


def test_log10_floor(spark):
    got = col_values(spark, [0.0, 100.0, -1.0, None], X.log10_floor, "double")
    assert got[0] == -10.0 and got[1] == 2.0 and math.isnan(got[2]) and got[3] is None


def test_round_half_away_matches_binary_value(spark):
    got = col_values(spark, [2.25, 0.25, 1234.45, 509.04999999999995, 509.05, -2.25], lambda c: X.round_half_away(c, 1),
                     "double")
    # 509.04999999999995 * 10 is exactly 5090.5 in binary, so it rounds up as in DuckDB/Polars
    # (Spark's decimal-text ``round`` would give 509.0 here).
    assert got == [2.3, 0.3, 1234.5, 509.1, 509.1, -2.3]


def test_power_round_squares_before_rounding(spark):
    assert col_values(spark, [4.45], lambda c: X.power_round(c, 2, 1), "double") == [19.8]


def test_dates(spark):
    got = col_values(spark, ["Apr 11 2022  5:12AM", "Jan 31 2019 10:25AM"], X.parse_date_clock12)
    assert got == [dt.date(2022, 4, 11), dt.date(2019, 1, 31)]
    df = spark.createDataFrame([("4022-01-05 10:00", "2021-01-01 00:00"), (None, "2021-01-01 00:00"),
                                ("2022-01-05 00:00:00.000", "2020-02-02 10:00"), ("NA", None)], "a string, b string")
    got = [r[0] for r in df.select(X.first_valid_date(["a", "b"])).collect()]
    assert got == [dt.date(4022, 1, 5), dt.date(2021, 1, 1), dt.date(2020, 2, 2), None]
    got = col_values(spark, ["03-1950", "12-2001"], X.month_year_to_dob)
    assert got == [dt.date(1950, 3, 1), dt.date(2001, 12, 1)]
    df = spark.createDataFrame([("2022-01-05", None)], "a string, b string")
    r = df.select(X.day_bounds("a"), X.day_bounds("a", end=True), X.day_bounds("b")).first()
    assert r[0] == dt.datetime(2022, 1, 5) and r[1] == dt.datetime(2022, 1, 5, 23, 59, 59) and r[2] is None


def test_map_strict(spark):
    ok = col_values(spark, ["1", "2", None], lambda c: X.map_strict(c, {"1": "M", "2": "F"}))
    assert ok == ["M", "F", None]
    with pytest.raises(Exception):
        col_values(spark, ["3"], lambda c: X.map_strict(c, {"1": "M", "2": "F"}))


def test_range_position_inclusive_nan_above(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (0.99,), (5.01,), (float("nan"),), (None,)], "v double")
    got = [r[0] for r in df.select(X.range_position("v", F.lit(1.0), F.lit(5.0))).collect()]
    assert got == ["ok", "ok", "below_min", "above_max", "above_max", None]


def test_day_bounds_ignore_session_time_zone(spark):
    """A midnight skipped by a DST change in the session zone stays midnight."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        df = spark.createDataFrame([("1995-10-15",)], "d string")
        r = df.select(X.day_bounds("d"), X.day_bounds("d", end=True), X.round_to_day(X.day_bounds("d", end=True))).first()
        assert r[0] == dt.datetime(1995, 10, 15) and r[1] == dt.datetime(1995, 10, 15, 23, 59, 59)
        assert r[2] == dt.date(1995, 10, 16)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
