"""Terms -> traits, unit harmonisation and range checks.

Dictionaries are small and curated (hundreds of rows). No join carries a hint: Spark broadcasts
the dictionary from its measured size, and shuffles (with skew handling) beyond its threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitflow import schema as S
from traitflow.functions import scalars as X


def trait_dictionary(traits: DataFrame, aliases: DataFrame) -> DataFrame:
    """Denormalised trait x alias x bounds (left join: a trait without aliases keeps a row)."""
    return traits.join(aliases, "trait", "left").select(
        "trait", "target_units", "min", "max", "alias")


def join_terms_to_traits(df: DataFrame, dictionary: DataFrame, term_col: str = "original_term") -> DataFrame:
    """Left join on the exact, case-sensitive term. Unmatched readings keep null trait columns."""
    return df.join(dictionary, df[term_col] == dictionary["alias"], "left").drop("alias")


def join_unit_converter(df: DataFrame, units: DataFrame, unit_col: str = "result_value_units",
                        target_col: str = "target_units") -> DataFrame:
    """Left join on (unit, target unit); adds ``target``, ``multiplication_factor`` and
    ``unit_matched``. The converter's (unit, target) key is unique, so rows never fan out."""
    u = units.select(F.col("result_value_units").alias("_u"), "target", "multiplication_factor")
    joined = df.join(u, (df[unit_col] == u["_u"]) & (df[target_col] == u["target"]), "left")
    return joined.withColumn("unit_matched", F.col("_u").isNotNull()).drop("_u")


def converted_value(trait="trait", unit="result_value_units", result="result",
                    factor="multiplication_factor"):
    """HbA1c in percent -> IFCC formula; else scale by a factor other than 1; else unchanged
    (no converter row: the value passes unconverted)."""
    t, u, r, f = F.col(trait), F.col(unit), F.col(result), F.col(factor)
    return (F.when((t == S.HBA1C_TRAIT) & u.isin(S.HBA1C_PERCENT_UNITS), X.hba1c_percent_to_ifcc(r))
            .when(f != 1, r * f)
            .otherwise(r))


def harmonise_units(df: DataFrame, units: DataFrame) -> DataFrame:
    """Drop null units, convert to the trait's target unit, flag the range, add log10."""
    return converted_and_ranged(join_unit_converter(df.filter(F.col("result_value_units").isNotNull()), units))


def converted_and_ranged(joined: DataFrame) -> DataFrame:
    """``final`` in the trait's target unit, its range flag and log10, from a frame that has the converter's columns."""
    out = joined.withColumn("final", converted_value())
    out = out.withColumn("range_position", X.range_position("final", "min", "max"))
    return out.withColumn("final_log10", X.log10_floor("final"))


def unrecovered_terms(df: DataFrame, aliases: DataFrame, term_col: str = "original_term") -> DataFrame:
    """Terms (trimmed) that match no alias, with their reading counts, most frequent first."""
    a = aliases.select("alias").distinct()
    terms = df.select(term_col)
    missing = terms.join(a, X.strip_chars(terms[term_col]) == a["alias"], "left_anti")
    return missing.groupBy(term_col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), term_col)


def units_counts(df: DataFrame) -> DataFrame:
    """People per (term, unit): distinct (person, term, unit) counted by (term, unit)."""
    return (df.select("pseudo_nhs_number", "original_term", "result_value_units").distinct()
            .groupBy("original_term", "result_value_units").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "original_term", "result_value_units"))


def provenance_counts(df: DataFrame) -> DataFrame:
    return (df.groupBy("provenance").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "provenance"))
