"""Schemas, closed sets and validators shared by all steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# Fixed values (must stay equal to the modelled pipeline's definitions)
# ---------------------------------------------------------------------------------------
# Region labels of a hospital-stay segment, in their canonical order.
REGION_ORDER = ["APC", "buffer_before", "buffer_after"]
# Default buffer lengths around an admitted-care stay, in days.
BUFFER_BEFORE_DAYS = 14
BUFFER_AFTER_DAYS = 14
# Admissions are kept when longer than this many days after rounding to dates.
MIN_ADMISSION_DAYS = 2
# Range positions of a harmonised value.
RANGE_POSITIONS = ["below_min", "ok", "above_max"]
# Sources of a reading.
SOURCE_OPTIONS = ["primary_care", "secondary_care"]
# Output settings: readings inside the buffered stays, outside them, and all.
SETTINGS = ["in_hospital", "out_hospital", "all"]
# HbA1c percentage spellings and the NGSP -> IFCC conversion (mmol/mol = 10.93 * % - 23.50).
HBA1C_TRAIT = "HbA1c"
HBA1C_PERCENT_UNITS = ["%", "% total Hb", "%Hb", "per cent"]
HBA1C_SLOPE = 10.93
HBA1C_INTERCEPT = -23.50
# Value that replaces 0 before a log10.
LOG10_ZERO_FLOOR = 1e-10
# Days in a year for ages, and the youngest age kept.
DAYS_PER_YEAR = 365.25
MIN_AGE_YEARS = 16
# 11-day tiles (windows of 10 days, every 11 days) aligned on the Unix epoch.
TILE_EVERY_DAYS = 11
# Questionnaire gender codes.
GENDER_CODES = {"1": "M", "2": "F"}
# Result wrappers that are taken off, in this order, and the year repair of the date check.
RESULT_WRAPPERS = [r"^\{(.*?)\}$", r"^\((.*?)\)$", r"^\*\{(.*?)\}$"]
YEAR_4XXX = r"^4(\d{3})(.*?)$"
# Columns of the tables and output files.
COMBO_SCHEMA = T.StructType([
    T.StructField("pseudo_nhs_number", T.StringType()),
    T.StructField("test_date", T.DateType()),
    T.StructField("original_term", T.StringType()),
    T.StructField("result", T.DoubleType()),
    T.StructField("result_value_units", T.StringType()),
    T.StructField("provenance", T.StringType()),
    T.StructField("source", T.StringType()),
])
COMBO_COLUMNS = [f.name for f in COMBO_SCHEMA.fields]
# Columns that define a distinct reading (provenance and source are not part of it).
READING_KEY = ["pseudo_nhs_number", "test_date", "original_term", "result", "result_value_units"]

TILED_COLUMNS = ["pseudo_nhs_number", "trait", "unit", "value", "date", "gender",
                 "age_at_test", "minmax_outlier", "region_types"]
READINGS_FILE_COLUMNS = TILED_COLUMNS[:-1]
PER_PERSON_STATS_COLUMNS = ["pseudo_nhs_number", "trait", "median", "mean", "max", "min",
                            "earliest", "latest", "n"]
# ---------------------------------------------------------------------------------------


class ClosedSetError(ValueError):
    """A column holds a value outside its closed set."""


def check_closed_set(df: DataFrame, column: str, allowed: list[str], allow_null: bool = False) -> None:
    """Fail when ``column`` holds values outside ``allowed`` (one small distributed job)."""
    cond = ~F.col(column).isin(allowed)
    if not allow_null:
        cond = cond | F.col(column).isNull()
    bad = df.filter(cond).select(column).distinct().limit(20).collect()
    if bad:
        raise ClosedSetError(f"{column}: values outside the closed set: {[r[0] for r in bad]}")


def ensure_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df
