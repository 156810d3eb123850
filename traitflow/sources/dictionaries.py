"""Dictionary loaders: traits (bounds), aliases and unit conversions, with validation.

Rows whose first field starts with ``#`` are data, not comments: they load as-is and simply
never match a reading (a disabled entry). Dictionaries are small and curated; they are
validated once (closed sets, unique keys) and broadcast by the joins that use them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitflow import schema as S
from traitflow.operators.audit import check_dictionary_unique

TRAITS_SCHEMA = T.StructType([T.StructField("trait", T.StringType()), T.StructField("target_units", T.StringType()),
                              T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType())])
ALIASES_SCHEMA = T.StructType([T.StructField("trait", T.StringType()), T.StructField("alias", T.StringType())])
UNITS_SCHEMA = T.StructType([T.StructField("result_value_units", T.StringType()),
                             T.StructField("target", T.StringType()),
                             T.StructField("multiplication_factor", T.DoubleType())])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").schema(schema).csv(path))


def load_units(spark: SparkSession, path: str) -> DataFrame:
    """Unit converter; the (unit, target) key must be unique (duplicates would fan out rows)."""
    units = _read(spark, path, UNITS_SCHEMA)
    check_dictionary_unique(units, ["result_value_units", "target"])
    return units


def target_units(units: DataFrame) -> list[str]:
    """Closed set of target units (bounded by the dictionary)."""
    return sorted(r[0] for r in units.select("target").distinct().collect() if r[0] is not None)


def load_traits(spark: SparkSession, path: str, allowed_units: list[str] | None = None) -> DataFrame:
    traits = _read(spark, path, TRAITS_SCHEMA)
    # one row per trait: the target unit and bounds are a function of the trait (the tile step
    # and the range check rely on it)
    check_dictionary_unique(traits, ["trait"])
    if allowed_units is not None:
        active = traits.filter(~F.col("trait").startswith("#"))
        S.check_closed_set(active, "target_units", allowed_units)
    return traits


def load_aliases(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ALIASES_SCHEMA)
