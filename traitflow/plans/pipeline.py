"""The end-to-end plan: readings + stays + dictionaries + people -> tiled, classified readings.

Shuffle plan at scale (readings are the only large input):
  * dictionary, unit and people joins carry no hint: Spark broadcasts what is below its size
    threshold and shuffles the rest;
  * the tile dedup is one partial aggregation on (person, trait, value, tile);
  * hospital regions are looked up for the tiled survivors only (regions depend on
    (person, date), and the survivor's date decides them), so the range join and its
    join-back run on the reduced table;
  * stays go through the sweep-line interval algebra, shuffled once by person.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitflow import schema as S
from traitflow.functions import scalars as X
from traitflow.operators import audit as AU
from traitflow.operators import filters as FL
from traitflow.operators import intervals as IV
from traitflow.operators import people as PE
from traitflow.operators import regions as RG
from traitflow.operators import tiles as TI
from traitflow.operators import traits as TR
from traitflow.session import spread


def ranged_readings(readings: DataFrame, traits: DataFrame, aliases: DataFrame, units: DataFrame) -> DataFrame:
    """Combo -> trait-mapped, unit-harmonised, range-flagged readings."""
    x = TR.join_terms_to_traits(readings, TR.trait_dictionary(traits, aliases))
    return TR.harmonise_units(x.filter(F.col("trait").isNotNull()), units)


def people_restricted(ranged: DataFrame, linkage: DataFrame, questionnaire: DataFrame, as_of: str) -> DataFrame:
    """Valid ids, demographics, in-range values, plausible dates, age >= 16. The readings are dealt by person once, to
    partitions that grow in number with the input; the people joins and the tile dedup work inside these."""
    # the ids are dealt, too: a side that is grouped already would impose its number of partitions on the readings
    valid = spread(PE.valid_pseudo_nhs_numbers(linkage), "pseudo_nhs_number")
    x = PE.join_valid_people_semi(spread(ranged, "pseudo_nhs_number"), valid)
    demo = PE.valid_demographics(linkage, PE.questionnaire_demographics(questionnaire))
    x = PE.join_demographics(x, demo)
    x = FL.filter_in_range(x)
    x = FL.filter_plausible_dates(x, as_of)
    return FL.filter_min_age(x)


def reading_rules(as_of: str) -> AU.Rules:
    """What a reading has to satisfy, in the order in which the steps of the pipeline ask for it."""
    age = F.col("age_at_test")
    return [("known_term", F.col("trait").isNotNull()), ("has_unit", F.col("result_value_units").isNotNull()),
            ("known_person", F.col("known_person")), ("range_ok", F.col("range_position") == "ok"),
            ("plausible_dates", (age >= 0) & (F.col("test_date") <= F.lit(as_of).cast("date"))),
            ("min_age", age >= S.MIN_AGE_YEARS)]


def traced_readings(readings: DataFrame, traits: DataFrame, aliases: DataFrame, units: DataFrame, linkage: DataFrame,
                    questionnaire: DataFrame, as_of: str) -> DataFrame:
    """Every reading of the combo (once per trait that its term names) with all derived columns and ``rule``: the number of
    the first of ``reading_rules`` that drops it, 0 for the readings that the pipeline keeps. One pass."""
    x = TR.join_terms_to_traits(readings, TR.trait_dictionary(traits, aliases))
    x = TR.converted_and_ranged(TR.join_unit_converter(x, units))
    demo = PE.valid_demographics(linkage, PE.questionnaire_demographics(questionnaire)).withColumn("known_person", F.lit(True))
    x = x.join(demo, "pseudo_nhs_number", "left").withColumn("age_at_test", X.age_at_test("test_date", "dob"))
    return AU.traced(x.withColumn("known_person", F.coalesce("known_person", F.lit(False))), reading_rules(as_of))


def tiled_regions(checked: DataFrame, segments: DataFrame) -> DataFrame:
    """Readings that passed every rule -> tiled readings with ``region_types``."""
    with_regions = RG.add_region_types(TI.tile_dedup_11d(checked).withColumnRenamed("date", "test_date"), segments)
    return with_regions.withColumnRenamed("test_date", "date").select(*S.TILED_COLUMNS)


def quant_pipeline(readings: DataFrame, stays: DataFrame, traits: DataFrame, aliases: DataFrame,
                   units: DataFrame, linkage: DataFrame, questionnaire: DataFrame, as_of: str,
                   segments: DataFrame | None = None) -> DataFrame:
    """Tiled readings with ``region_types`` (columns ``schema.TILED_COLUMNS``).

    ``segments`` may be passed in when the admission windows are already staged; otherwise
    they are part of this plan (read once, by the region join)."""
    if segments is None:
        segments = IV.admission_windows(stays)
    pre = people_restricted(ranged_readings(readings, traits, aliases, units), linkage, questionnaire, as_of)
    return tiled_regions(pre, segments)
