"""Stored sketches of releases: distinct people per step and source, and value distributions per trait.

Sketches of different pulls merge without reading the pulls again. People: theta sketches of 2 ** ``LG_ENTRIES`` entries, exact
up to that many people and with a relative standard error of 1 / sqrt(entries) (0.4 %) above; they also give overlaps
between sources. Values: KLL sketches, of which only the bracket of a median is taken: ``exact_medians`` counts what
lies below the bracket and sorts the distinct values inside it, so medians are exact whatever the sketch's error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitflow.operators.audit import Rules

LG_ENTRIES = 16
KLL_K = 400             # rank error of a KLL sketch: about 0.7 %
BRACKET = 0.02          # ranks on each side of the middle that the bracket takes in


def people_sketches(trace: DataFrame, rules: Rules, by: str = "provenance", person: str = "pseudo_nhs_number", col: str = "rule") -> DataFrame:
    """``by``, step, label, people (theta sketch): the people with a reading left after each rule (step 0: all), from one
    aggregation of a rule trace."""
    labels = ["all"] + [label for label, _ in rules]
    left = [F.lit(True)] + [(F.col(col) == 0) | (F.col(col) > i) for i in range(1, len(rules) + 1)]
    sketches = trace.groupBy(by).agg(*[F.theta_sketch_agg(F.when(keep, F.col(person)), F.lit(LG_ENTRIES)).alias(f"s{i}") for i, keep in enumerate(left)])
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(label).alias("label"), F.col(f"s{i}").alias("people")) for i, label in enumerate(labels)])
    return sketches.select(by, F.explode(steps).alias("x")).select(by, "x.*")


def people_counts(sketches: DataFrame, by: tuple[str, ...] = ("step", "label")) -> DataFrame:
    """Distinct people per ``by``, sketches of several sources or releases merged."""
    return sketches.groupBy(*by).agg(F.theta_sketch_estimate(F.theta_union_agg("people", F.lit(LG_ENTRIES))).alias("n_people"))


def people_overlaps(sketches: DataFrame, step: int = 0, by: str = "provenance") -> DataFrame:
    """first, second, n_people: people in both of two sources after a step. Sources are a closed set of a few dozen."""
    at = sketches.filter(F.col("step") == step)
    one = at.select("step", F.col(by).alias("first"), F.col("people").alias("a"))
    two = at.select("step", F.col(by).alias("second"), F.col("people").alias("b"))
    return one.join(two, "step").filter(F.col("first") < F.col("second")).select("first", "second", F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("n_people"))


def exact_people_counts(trace: DataFrame, rules: Rules, person: str = "pseudo_nhs_number", col: str = "rule") -> DataFrame:
    """The counts of ``people_counts`` from the readings themselves."""
    labels = ["all"] + [label for label, _ in rules]
    # a person is left after a step if one reading is: the last step that any of the readings passes decides
    passed = F.max(F.when(F.col(col) == 0, len(rules)).otherwise(F.col(col) - 1))
    people = trace.filter(F.col(person).isNotNull()).groupBy(person).agg(passed.alias("passed"))
    counts = people.agg(*[F.count(F.when(F.col("passed") >= i, 1)).alias(f"n{i}") for i in range(len(labels))])
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(label).alias("label"), F.col(f"n{i}").alias("n_people")) for i, label in enumerate(labels)])
    return counts.select(F.explode(steps).alias("x")).select("x.*")


def value_sketches(readings: DataFrame, keys: tuple[str, ...] = ("setting", "trait")) -> DataFrame:
    """``keys``, n, total, low, high, people (theta) and spread (KLL) of the values of one pull."""
    v = F.col("value")
    return readings.filter(v.isNotNull()).groupBy(*keys).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.theta_sketch_agg("pseudo_nhs_number", F.lit(LG_ENTRIES)).alias("people"), F.kll_sketch_agg_double(v.cast("double"), F.lit(KLL_K)).alias("spread"))


def merged_values(sketches: DataFrame, keys: tuple[str, ...] = ("setting", "trait")) -> DataFrame:
    """The sketches of several pulls as one, and the bracket of the median."""
    one = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.theta_union_agg("people", F.lit(LG_ENTRIES)).alias("people"), F.kll_merge_agg_double("spread").alias("spread"))
    rank = lambda q: F.kll_sketch_get_quantile_double("spread", F.lit(q))
    return one.withColumn("from_value", rank(0.5 - BRACKET)).withColumn("to_value", rank(0.5 + BRACKET))


def exact_medians(readings: DataFrame, merged: DataFrame, keys: tuple[str, ...] = ("setting", "trait")) -> DataFrame:
    """``keys`` and the interpolated median: readings below the bracket are counted, the distinct values inside it are sorted. A group
    whose middle lies outside its bracket (the sketch's error was larger) is taken with its whole range."""
    def inside(groups: DataFrame) -> DataFrame:
        v = F.col("value")
        rows = readings.filter(v.isNotNull()).select(*keys, "value").join(groups.select(*keys, "n", "from_value", "to_value"), list(keys))
        place = F.when(v < F.col("from_value"), F.lit(None).cast("double")).otherwise(v)
        counts = rows.filter(v <= F.col("to_value")).groupBy(*keys, "n", place.alias("value")).agg(F.count(F.lit(1)).alias("c"))
        order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("value"))
        upto = F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ranked = counts.select(*keys, "n", "value", upto.alias("upto"), (upto - F.col("c")).alias("before"))
        first, second = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
        holds = lambda r: (F.col("before") <= r) & (r < F.col("upto"))
        return ranked.groupBy(*keys).agg(F.max(F.when(holds(first), F.col("value"))).alias("v1"), F.max(F.when(holds(second), F.col("value"))).alias("v2"))

    found = inside(merged)
    good = F.col("v1").isNotNull() & F.col("v2").isNotNull()
    wide = merged.join(found.filter(~good).select(*keys), list(keys), "left_semi").withColumn("from_value", F.col("low")).withColumn("to_value", F.col("high"))
    both = found.filter(good).unionByName(inside(wide))
    return both.select(*keys, ((F.col("v1") + F.col("v2")) / 2).alias("median"))


def summary(merged: DataFrame, medians: DataFrame, keys: tuple[str, ...] = ("setting", "trait")) -> DataFrame:
    """``keys``, median, mean, min, max, n_people, n: a study summary from stored sketches and one pass for the medians."""
    return merged.join(medians, list(keys)).select(
        *keys, "median", (F.col("total") / F.col("n")).alias("mean"), F.col("low").alias("min"), F.col("high").alias("max"),
        F.theta_sketch_estimate("people").alias("n_people"), "n")


def relative_error(lg_entries: int = LG_ENTRIES) -> float:
    """Relative standard error of the people counts beyond 2 ** lg_entries people."""
    return float((1 << lg_entries) ** -0.5)
