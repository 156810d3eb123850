"""11-day tile deduplication: one reading per (person, trait, value, tile), the earliest.

Tiles are epoch-aligned blocks of 11 consecutive dates (windows of 10 days, every 11 days,
both ends closed), so every date is in exactly one tile. The step is one aggregation keyed on
(person, trait, value, tile): partial aggregation removes repeats before the shuffle and the
key spreads a heavy person over many partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitflow import schema as S
from traitflow.functions import scalars as X


def tile_dedup_11d(df: DataFrame, every_days: int = S.TILE_EVERY_DAYS,
                   dependent: tuple[str, ...] = ("target_units", "gender", "dob", "range_position")) -> DataFrame:
    """Ranged readings (``final``, ``test_date``, ...) -> tiled readings with the output names
    ``unit, value, date, gender, age_at_test, minmax_outlier``.

    The survivor of a tile is its earliest reading. Every carried column is fixed by the group
    key (unit by trait, gender and dob by person, the range flag is 'ok' after filtering), so
    they join the grouping key and the step is a plain ``min(date)`` hash aggregation with
    map-side combine; ``age_at_test`` is recomputed for the surviving date."""
    keyed = (df.filter(F.col("final").isNotNull())
             .withColumn("_tile", X.tile_index("test_date", every_days)))
    extra = [c for c in dependent if c in df.columns]
    first = keyed.groupBy("pseudo_nhs_number", "trait", "final", "_tile", *extra).agg(
        F.min("test_date").alias("date"))
    names = {"target_units": "unit", "range_position": "minmax_outlier"}
    cols = ["pseudo_nhs_number", "trait"]
    if "target_units" in extra:
        cols.append(F.col("target_units").alias("unit"))
    cols += [F.col("final").alias("value"), "date"]
    if "gender" in extra:
        cols.append("gender")
    if "dob" in extra:
        cols.append(X.age_at_test("date", "dob").alias("age_at_test"))
    if "range_position" in extra:
        cols.append(F.col("range_position").alias(names["range_position"]))
    return first.select(*cols)
