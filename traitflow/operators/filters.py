"""Row filters and small column repairs (three-valued logic as in SQL: a null test drops)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitflow import schema as S
from traitflow.functions import scalars as X


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def computed(df: DataFrame, cols: list[str]) -> DataFrame:
    """``df`` with ``cols`` computed once per row. Catalyst copies a column's expression into every expression and filter
    that uses it; the output of a generator is not copied."""
    cols = [c for c in df.columns if c in cols]
    if not cols:
        return df
    others = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    out = df.select(*others, F.inline(F.array(F.struct(*[F.col(f"`{c}`").alias(c) for c in cols]))))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def filter_not_null_all(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.filter(_all([F.col(c).isNotNull() for c in cols]))


def filter_literal_blocklist(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Drop rows equal to any listed literal. Null values drop too (``ne`` is null on null)."""
    return df.filter(~F.col(col).isin(list(values))) if values else df.filter(F.col(col).isNotNull())


def filter_in_blocklist(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    return filter_literal_blocklist(df, col, values)


def any_pattern(patterns: list[str]) -> str:
    """One regex matching where any of ``patterns`` matches (each in its own group, so inline
    flags such as ``(?i)`` and anchors keep their scope)."""
    return "|".join(f"(?:{p})" for p in patterns)


def filter_regex_blocklist(df: DataFrame, col: str, patterns: list[str]) -> DataFrame:
    """Drop rows whose value contains a match of any pattern (Java regex; ``(?i)`` allowed).
    A null value drops too. The patterns run as one alternation: one regex scan per value."""
    return df.filter(~F.col(col).rlike(any_pattern(patterns))) if patterns else df


def filter_prefix_suffix(df: DataFrame, col: str, starts: list[str] = (), ends: list[str] = ()) -> DataFrame:
    conds = [~F.col(col).startswith(s) for s in starts] + [~F.col(col).endswith(e) for e in ends]
    return df.filter(_all(conds)) if conds else df


def filter_regex_allowlist(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(F.col(col).rlike(pattern))


def filter_not_nan(df: DataFrame, col: str) -> DataFrame:
    """Drop NaN and null."""
    return df.filter(X.not_nan(col))


def filter_nonempty(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) != "")


def filter_null_units(df: DataFrame, col: str = "result_value_units") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def filter_plausible_dates(df: DataFrame, as_of: str, age_col: str = "age_at_test",
                           date_col: str = "test_date") -> DataFrame:
    """Keep readings taken at or after birth and not after ``as_of`` (yyyy-MM-dd)."""
    return df.filter((F.col(age_col) >= 0) & (F.col(date_col) <= F.lit(as_of).cast("date")))


def filter_min_age(df: DataFrame, min_age: float = S.MIN_AGE_YEARS, age_col: str = "age_at_test") -> DataFrame:
    return df.filter(F.col(age_col) >= min_age)


def filter_in_range(df: DataFrame, col: str = "range_position") -> DataFrame:
    return df.filter(F.col(col) == "ok")


def impute_unit_from_term(df: DataFrame, term_col: str, rules: list[tuple[str, str]],
                          unit_col: str = "result_value_units") -> DataFrame:
    """First matching case-insensitive ``contains`` rule sets the unit; no match gives null."""
    out = None
    for needle, unit in rules:
        cond = F.col(term_col).rlike("(?i)" + X._literal_regex(needle))
        out = F.when(cond, F.lit(unit)) if out is None else out.when(cond, F.lit(unit))
    return df.withColumn(unit_col, out)


def impute_unit_for_term(df: DataFrame, term: str, unit: str, term_col: str = "original_term",
                         unit_col: str = "result_value_units") -> DataFrame:
    """Fill a null unit for one exact term."""
    cond = (F.col(term_col) == term) & F.col(unit_col).isNull()
    return df.withColumn(unit_col, F.when(cond, F.lit(unit)).otherwise(F.col(unit_col)))


def conditional_value_repair(df: DataFrame, col: str, term_col: str, term: str, text: str = ",") -> DataFrame:
    """Remove every ``text`` (thousand separators) from ``col`` for one term only."""
    return df.withColumn(col, F.when(F.col(term_col) == term, X.replace_all_literal(col, text))
                         .otherwise(F.col(col)))


def typo_repair(df: DataFrame, col: str, pattern: str = r"3\.6\.1", replacement: str = "36.1") -> DataFrame:
    return df.withColumn(col, X.replace_first(col, pattern, replacement))


def tag_provenance(df: DataFrame, provenance: str, source: str) -> DataFrame:
    if source not in S.SOURCE_OPTIONS:
        raise S.ClosedSetError(f"source {source!r} not in {S.SOURCE_OPTIONS}")
    return df.withColumn("provenance", F.lit(provenance)).withColumn("source", F.lit(source))


def canonical_select(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename (raw -> canonical) then project to the combo columns with their types."""
    for raw, canon in (mapping or {}).items():
        if raw != canon:
            df = df.withColumnRenamed(raw, canon)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.COMBO_SCHEMA.fields])
