"""Column -> Column helpers. All are built from Spark SQL functions (JVM side, codegen).

Rules that differ between engines and matter for equal results:
  * number parsing never trims and never accepts suffixes: a regex guard runs before the cast;
  * ``replace_first`` replaces only the first match (Spark's regexp_replace replaces all);
  * prefix/suffix chains strip one literal occurrence per step, in order;
  * strict variants fail the job on bad input, lenient ones give null.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitflow import schema as S

ColumnOrName = Column | str

# A plain decimal number: optional sign, digits with optional fraction (or a bare fraction),
# optional exponent. No spaces, no suffixes, no NaN/inf words.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_regex(text: str) -> str:
    """Regex that matches ``text`` literally (escapes are valid in Java regex too)."""
    return re.escape(text)


def _literal_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


# --- strings -------------------------------------------------------------------------------

def strip_prefix(c: ColumnOrName, prefix: str) -> Column:
    """Remove one leading occurrence of the literal ``prefix``."""
    return F.regexp_replace(_c(c), "^" + _literal_regex(prefix), "")


def strip_suffix(c: ColumnOrName, suffix: str) -> Column:
    """Remove one trailing occurrence of the literal ``suffix``."""
    return F.regexp_replace(_c(c), "(?s)" + _literal_regex(suffix) + r"\z", "")


def strip_prefix_chain(c: ColumnOrName, prefixes: list[str]) -> Column:
    """Strip each prefix once, in the given order (order changes results)."""
    return reduce(strip_prefix, prefixes, _c(c))


def strip_suffix_chain(c: ColumnOrName, suffixes: list[str]) -> Column:
    return reduce(strip_suffix, suffixes, _c(c))


def replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """Replace only the first regex match. ``$n`` group references keep their meaning."""
    shifted = re.sub(r"\$(\d+)", lambda m: "$" + str(int(m.group(1)) + 1), replacement)
    return F.regexp_replace(_c(c), "^((?s:.*?))(?:" + pattern + ")", "$1" + shifted)


def replace_all(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(_c(c), pattern, replacement)


def replace_all_literal(c: ColumnOrName, text: str, replacement: str = "") -> Column:
    """Replace every literal occurrence of ``text``."""
    return F.regexp_replace(_c(c), _literal_regex(text), _literal_replacement(replacement))


def unwrap_brackets(c: ColumnOrName) -> Column:
    """``{x}`` -> x, then ``(x)`` -> x, then ``*{x}`` -> x (whole-value wrappers only)."""
    return reduce(lambda out, wrapper: F.regexp_replace(out, wrapper, "$1"), S.RESULT_WRAPPERS, _c(c))


def strip_chars(c: ColumnOrName) -> Column:
    """Trim leading and trailing whitespace (any kind, not only spaces)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def collapse_spaces(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), " +", " ")


def file_stem(path: ColumnOrName, extension: str = ".csv") -> Column:
    """Last path component without ``extension``."""
    return F.element_at(F.split(strip_suffix(path, extension), "/"), -1)


# --- numbers -------------------------------------------------------------------------------

def is_plain_number(c: ColumnOrName) -> Column:
    return _c(c).rlike(NUMBER_PATTERN)


def parse_number_lenient(c: ColumnOrName) -> Column:
    """Text -> double; anything that is not a plain number gives null."""
    c = _c(c)
    return F.when(c.rlike(NUMBER_PATTERN), c.cast("double"))


def parse_number_strict(c: ColumnOrName, what: str = "result") -> Column:
    """Text -> double; null stays null, anything else that is not a plain number fails the job."""
    c = _c(c)
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(c.rlike(NUMBER_PATTERN), c.cast("double"))
            .otherwise(F.raise_error(F.concat(F.lit(f"strict cast of {what} failed: "), c)).cast("double")))


def not_nan(c: ColumnOrName) -> Column:
    """True only for non-null, non-NaN values (null counts as NaN, as in the modelled filter)."""
    c = _c(c)
    return c.isNotNull() & ~F.isnan(c)


def log10_floor(c: ColumnOrName) -> Column:
    """log10 with 0 replaced by 1e-10 first; negative values give NaN (never null)."""
    v = F.when(_c(c) == 0, F.lit(S.LOG10_ZERO_FLOOR)).otherwise(_c(c))
    return F.when(v > 0, F.log10(v)).when(v.isNotNull(), F.lit(float("nan")))


def round_half_away(c: ColumnOrName, scale: int = 0) -> Column:
    """Round a double the way array engines do: scale, round half away from zero on the binary
    value, unscale (Spark's ``round`` rounds the decimal text instead, which differs for
    values such as 509.05 stored as 509.04999...)."""
    k = float(10 ** scale)
    return F.round(_c(c) * F.lit(k), 0) / F.lit(k)


def power_round(c: ColumnOrName, power: float = 2, scale: int = 1) -> Column:
    """Square (or other power) first, then round."""
    return round_half_away(F.pow(_c(c), F.lit(power)), scale)


def hba1c_percent_to_ifcc(c: ColumnOrName) -> Column:
    return F.lit(S.HBA1C_SLOPE) * _c(c) + F.lit(S.HBA1C_INTERCEPT)


def range_position(value: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """below_min / ok / above_max, both bounds inclusive; NaN sorts above every number."""
    v, lo, hi = _c(value), _c(lo), _c(hi)
    return (F.when(v < lo, "below_min")
            .when((v >= lo) & (v <= hi), "ok")
            .when(v > hi, "above_max"))


def row_hash(*cols: ColumnOrName) -> Column:
    """64-bit content hash of a reading (informative; dedup uses the columns themselves)."""
    return F.xxhash64(*[_c(c) for c in cols])


# --- dates ---------------------------------------------------------------------------------

def parse_date_lenient(c: ColumnOrName, fmt: str) -> Column:
    """Text -> date with a Spark datetime pattern; no match gives null."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("date")


def parse_date_strict(c: ColumnOrName, fmt: str, what: str = "date") -> Column:
    c = _c(c)
    parsed = F.try_to_timestamp(c, F.lit(fmt)).cast("date")
    return F.coalesce(parsed, F.when(c.isNotNull(), F.raise_error(
        F.concat(F.lit(f"strict parse of {what} ({fmt}) failed: "), c)).cast("date")))


def parse_datetime_strict(c: ColumnOrName, fmt: str, what: str = "datetime") -> Column:
    """Text -> TIMESTAMP_NTZ (wall-clock, no time zone: a midnight that does not exist in the
    session zone because of a DST change stays midnight). Bad input fails the job."""
    c = _c(c)
    parsed = F.to_timestamp_ntz(c, F.lit(fmt))
    return F.coalesce(parsed, F.when(c.isNotNull(), F.raise_error(
        F.concat(F.lit(f"strict parse of {what} ({fmt}) failed: "), c)).cast("timestamp_ntz")))


def parse_date_clock12(c: ColumnOrName, strict: bool = False) -> Column:
    """``Apr 11 2022  5:12AM`` style stamps (repeated spaces collapsed first) -> date."""
    fmt = "MMM d yyyy h:mma"
    if strict:
        return parse_date_strict(collapse_spaces(c), fmt, "12-hour date")
    return F.try_to_timestamp(collapse_spaces(c), F.lit(fmt)).cast("date")


def first_valid_date(cols: list[ColumnOrName], fmt: str = "yyyy-MM-dd HH:mm") -> Column:
    """First candidate column that parses as a date, in order.

    Each candidate is checked after turning a leading year ``4xxx`` into ``2xxx``; the value
    taken is the parse of the candidate as written (so the repair only affects the check).
    """
    picks = []
    for c in cols:
        c = _c(c)
        repaired = F.regexp_replace(c, S.YEAR_4XXX, "2$1$2")
        ok = F.try_to_timestamp(repaired, F.lit(fmt)).isNotNull()
        picks.append(F.when(ok, F.try_to_timestamp(c, F.lit(fmt)).cast("date")))
    return F.coalesce(*picks)


def day_bounds(c: ColumnOrName, end: bool = False) -> Column:
    """``yyyy-MM-dd`` -> start (00:00:00) or end (23:59:59) of that day; null stays null."""
    clock = "23:59:59" if end else "00:00:00"
    return parse_datetime_strict(F.concat(_c(c), F.lit(clock)), "yyyy-MM-ddHH:mm:ss", "stay date")


def round_to_day(c: ColumnOrName) -> Column:
    """Datetime -> nearest date (12:00:00 and later round up)."""
    return F.to_date(F.date_trunc("day", _c(c) + F.expr("INTERVAL 12 HOURS")))


def month_year_to_dob(c: ColumnOrName) -> Column:
    """``MM-YYYY`` -> first day of that month."""
    return parse_date_strict(F.concat(F.lit("01-"), _c(c)), "dd-MM-yyyy", "month of birth")


def map_strict(c: ColumnOrName, mapping: dict[str, str], what: str = "value") -> Column:
    """Map through ``mapping``; an unmapped non-null value fails the job."""
    c = _c(c)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for k, v in mapping.items():
        out = out.when(c == k, F.lit(v))
    return out.otherwise(F.raise_error(F.concat(F.lit(f"unmapped {what}: "), c)).cast("string"))


def age_at_test(test_date: ColumnOrName, dob: ColumnOrName) -> Column:
    return F.datediff(_c(test_date), _c(dob)) / F.lit(S.DAYS_PER_YEAR)


def epoch_day(c: ColumnOrName) -> Column:
    return F.datediff(_c(c), F.lit("1970-01-01").cast("date"))


def tile_index(c: ColumnOrName, every_days: int = S.TILE_EVERY_DAYS) -> Column:
    """Epoch-aligned tile number; floor division keeps dates before 1970 correct."""
    return F.floor(epoch_day(c) / F.lit(every_days)).cast("long")


def coalesce_columns(*cols: ColumnOrName) -> Column:
    return F.coalesce(*[_c(c) for c in cols])
