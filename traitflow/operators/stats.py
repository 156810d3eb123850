"""Per-person, per-trait and cohort outputs.

Medians are exact (interpolated). Per-person statistics are one aggregation: a group is one
person's readings of a trait, and ``percentile`` keeps counts per distinct value, combined
map-side. For groups that hold a whole trait the median does not go through one task: values are
first counted per (group, value) - a partial aggregation whose shuffle key includes the value -
and the median is read off the running count of the distinct values near the middle (a window
that streams and can spill).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitflow.functions import scalars as X
from traitflow.session import spread


# Sketch accuracy for medians of coarse groups: the bracket holds about 4 / accuracy of a group.
MEDIAN_BAND_ACCURACY = 10_000


def exact_median(df: DataFrame, group_cols: list[str], value_col: str, out_col: str = "median",
                 extremes: dict[str, str] | None = None, band_accuracy: int | None = None) -> DataFrame:
    """``group_cols + [out_col]``: the interpolated median of non-null ``value_col``.

    ``extremes`` (e.g. ``{"min": "age_min", "max": "age_max", "n": "age_n"}``) also returns
    those statistics, read from the same window pass (no extra shuffle or join).

    ``band_accuracy`` is for coarse groups (a whole trait across everyone): a mergeable
    ``percentile_approx`` sketch per group brackets the median's rank (rank error at most
    n / accuracy), values outside the bracket collapse into one row below and one above, and
    only the bracket's distinct values reach the window. A group whose median rank falls
    outside its bracket (not expected) is recomputed without banding, so the result is exact.
    The brackets (a row per group, bounded by the dictionary) are broadcast, so the values meet them where they are read."""
    vals = df.filter(F.col(value_col).isNotNull()).select(*group_cols, F.col(value_col).alias("_v"))
    if not band_accuracy:
        return _median_from_counts(vals.groupBy(*group_cols, "_v").agg(F.count("*").alias("_c")),
                                   group_cols, out_col, extremes)
    eps = 2.0 / band_accuracy
    bounds = vals.groupBy(*group_cols).agg(
        F.percentile_approx("_v", [max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)], band_accuracy).alias("_q"),
        F.min("_v").alias("_gmin"), F.max("_v").alias("_gmax"))
    v, lo, hi = F.col("_v"), F.col("_q")[0], F.col("_q")[1]
    clipped = (vals.join(F.broadcast(bounds), group_cols)
               .select(*group_cols, F.when(v < lo, F.lit(float("-inf"))).when(v > hi, F.lit(float("inf")))
                       .otherwise(v).alias("_v"), "_gmin", "_gmax"))
    counts = clipped.groupBy(*group_cols, "_v", "_gmin", "_gmax").agg(F.count("*").alias("_c"))
    banded = _median_from_counts(counts, group_cols, out_col, extremes, exact_extremes=("_gmin", "_gmax"))
    ok = F.col(out_col).between(float("-1.7e308"), float("1.7e308"))   # false for +-inf and NaN
    # Groups whose median rank fell outside the bracket are recomputed without banding. The
    # branch is lazy: when no group needs it, no value of it is shuffled.
    bad_groups = banded.filter(~ok).select(*group_cols)
    redo = vals.join(F.broadcast(bad_groups), group_cols, "left_semi")
    full = _median_from_counts(redo.groupBy(*group_cols, "_v").agg(F.count("*").alias("_c")),
                               group_cols, out_col, extremes)
    return banded.filter(ok).unionByName(full)


def _median_from_counts(counts: DataFrame, group_cols: list[str], out_col: str,
                        extremes: dict[str, str] | None, exact_extremes: tuple[str, str] | None = None) -> DataFrame:
    """Median (and extremes) from ``(group, _v, _c)`` rows of distinct values and counts."""
    w = Window.partitionBy(*group_cols).orderBy("_v")
    whole = Window.partitionBy(*group_cols)
    lo_min = F.min("_v").over(whole) if exact_extremes is None else F.col(exact_extremes[0])
    hi_max = F.max("_v").over(whole) if exact_extremes is None else F.col(exact_extremes[1])
    ranked = counts.select(
        *group_cols, "_v",
        (F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c")).alias("_lo"),
        F.col("_c"),
        F.sum("_c").over(whole).alias("_n"),
        lo_min.alias("_min"), hi_max.alias("_max"))
    # 0-based ranks of the two middle values; a distinct value covers ranks [_lo, _lo + _c).
    r1 = F.floor((F.col("_n") - 1) / 2)
    r2 = F.ceil((F.col("_n") - 1) / 2)
    covers = lambda r: (F.col("_lo") <= r) & (r < F.col("_lo") + F.col("_c"))
    mids = ranked.filter(covers(r1) | covers(r2)).select(
        *group_cols, "_n", "_min", "_max",
        F.when(covers(r1), F.col("_v")).alias("_v1"),
        F.when(covers(r2), F.col("_v")).alias("_v2"))
    extra = {"min": F.max("_min"), "max": F.max("_max"), "n": F.max("_n")}
    return mids.groupBy(*group_cols).agg(((F.max("_v1") + F.max("_v2")) / 2).alias(out_col),
                                         *[extra[k].alias(v) for k, v in (extremes or {}).items()])


def _median(col: str):
    """Exact interpolated median; for groups of bounded size."""
    return F.percentile(col, F.lit(0.5))


def per_individual_stats(df: DataFrame, group_cols=("pseudo_nhs_number", "trait", "minmax_outlier"),
                         extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """median, mean, max, min, earliest, latest, n of ``value`` per person and trait.

    ``earliest``/``latest`` are the value at the first/last date (ties: smallest/largest value).
    """
    keys = list(extra_keys) + list(group_cols)
    out = df.groupBy(*keys).agg(
        _median("value").alias("median"),
        F.avg("value").alias("mean"), F.max("value").alias("max"), F.min("value").alias("min"),
        F.min(F.struct("date", "value"))["value"].alias("earliest"),
        F.max(F.struct("date", "value"))["value"].alias("latest"),
        F.count("value").alias("n"))
    return out.select(*list(extra_keys), "pseudo_nhs_number", "trait", "median", "mean", "max", "min",
                      "earliest", "latest", "n")


def trait_study_summary(df: DataFrame, keys=("setting", "trait")) -> DataFrame:
    """Per trait (and setting): median, mean, min, max, distinct people, observations, unit."""
    keys = list(keys) + ["unit"]   # the unit is fixed by the trait: grouping on it keeps a hash aggregate
    aggs = df.groupBy(*keys).agg(
        F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.countDistinct("pseudo_nhs_number").alias("n_people"), F.count("*").alias("n_obs"))
    # groups are whole traits: banded exact median (see exact_median)
    medians = exact_median(df, keys, "value", "median", band_accuracy=MEDIAN_BAND_ACCURACY)
    return aggs.join(medians, keys, "left").select(
        *keys[:-1], "median", "mean", "min", "max", "n_people", "n_obs", "unit")


def trait_log10_histogram(df: DataFrame, bins: int = 48, keys=("setting", "trait")) -> DataFrame:
    """log10(value) counts per trait, gender (and setting) in ``bins`` equal-width bins over the
    trait's [min, max] log value. Bin index is clamped to ``bins - 1``."""
    keys = list(keys)
    logs = df.filter(F.col("trait").isNotNull()).select(*keys, "gender", X.log10_floor("value").alias("log_x"))
    bounds = logs.groupBy(*keys).agg(F.min("log_x").alias("lo"), F.max("log_x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    idx = F.when(width > 0, F.least(F.floor((F.col("log_x") - F.col("lo")) / width), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    # ``bounds`` has one row per trait and setting (bounded by the trait dictionary).
    binned = logs.join(bounds, keys).select(
        *keys, "gender", idx.alias("bin"), (F.col("lo") + idx * width).alias("bin_start"),
        (F.col("lo") + (idx + 1) * width).alias("bin_end"))
    return binned.groupBy(*keys, "gender", "bin", "bin_start", "bin_end").agg(F.count("*").alias("n"))


def phenotype_table(df: DataFrame, ids: DataFrame, keys=("setting", "trait")) -> DataFrame:
    """FID '1', IID, median/min/max of ``value`` per trait (and setting) for one genotype cohort. Readings are dealt by
    person once, to partitions that grow in number with the input; a pivot of the rows works inside these."""
    from traitflow.operators.people import join_genotype_ids
    keys = list(keys)
    data = spread(join_genotype_ids(df, ids).select(*keys, "IID", "value"), "IID")
    out = data.groupBy(*keys, "IID").agg(_median("value").alias("median"), F.min("value").alias("min"), F.max("value").alias("max"))
    return out.select(*keys, F.lit("1").alias("FID"), "IID", "median", "min", "max")


def covariate_long(df: DataFrame, ids: DataFrame, keys=("setting",)) -> DataFrame:
    """Per (setting, IID, trait): min/median/max of age at test and of its square, both
    rounded to one decimal before and after aggregating (square taken before rounding). Readings are dealt by person
    once, to partitions that grow in number with the input; a pivot of the rows works inside these."""
    from traitflow.operators.people import join_genotype_ids
    keys = list(keys)
    ages = spread(join_genotype_ids(df, ids).filter(F.col("age_at_test").isNotNull()).select(*keys, "IID", "trait", "age_at_test"), "IID")
    data = ages.select(*keys, "IID", "trait", X.round_half_away("age_at_test", 1).alias("AgeAtTest"),
                       X.power_round("age_at_test", 2, 1).alias("AgeAtTest_Squared"))
    g = keys + ["IID", "trait"]
    out = data.filter(F.col("AgeAtTest").isNotNull() | F.col("AgeAtTest_Squared").isNotNull()).groupBy(*g).agg(*[
        f(c).alias(f"{name}_{stat}") for name, c in (("age", "AgeAtTest"), ("age2", "AgeAtTest_Squared"))
        for stat, f in (("min", F.min), ("median", _median), ("max", F.max))])
    return out.select(*g, *[X.round_half_away(c, 1).alias(c) for c in
                            ["age_min", "age2_min", "age_median", "age2_median", "age_max", "age2_max"]])


COVARIATE_STATS = [("age_min", "AgeAtTest", "min"), ("age2_min", "AgeAtTest_Squared", "min"),
                   ("age_median", "AgeAtTest", "median"), ("age2_median", "AgeAtTest_Squared", "median"),
                   ("age_max", "AgeAtTest", "max"), ("age2_max", "AgeAtTest_Squared", "max")]


def traits_present(df: DataFrame) -> list[str]:
    """Sorted traits that occur in ``df`` (a distinct over a column bounded by the dictionary)."""
    return sorted(r[0] for r in df.select("trait").distinct().collect() if r[0] is not None)


def covariate_megawide(df: DataFrame, ids: DataFrame, traits: list[str] | None = None,
                       keys=("setting",)) -> DataFrame:
    """One row per IID (per setting): ``FID, IID`` then for each trait in sorted order
    ``AgeAtTest.<t>.min, AgeAtTest_Squared.<t>.min, ...median, ...max``; absent -> null.

    ``traits`` defaults to the traits that occur in the data (as in the modelled output, which
    aligns the per-trait tables it finds); pass the dictionary list to fix the columns."""
    from traitflow.operators.people import join_genotype_ids
    keys = list(keys)
    long = covariate_long(df, ids, keys)
    if traits is None:   # the long table has no row without an age
        traits = traits_present(join_genotype_ids(df.filter(F.col("age_at_test").isNotNull()), ids))
    traits = sorted(traits)
    wide = long.groupBy(*keys, "IID").pivot("trait", traits).agg(
        *[F.first(c).alias(c) for c, _, _ in COVARIATE_STATS])
    cols = []
    for t in traits:
        for c, base, stat in COVARIATE_STATS:
            cols.append(F.col(f"`{t}_{c}`").alias(f"{base}.{t}.{stat}"))
    return wide.select(*keys, F.lit("1").alias("FID"), "IID", *cols)


def phenotype_wide(pheno: DataFrame, traits: list[str] | None = None, stats=("median", "min", "max"),
                   keys=("setting",)) -> DataFrame:
    """Long phenotype rows -> one row per IID with ``<trait>.<stat>`` columns (traits sorted,
    spaces in names as ``_``). One pivot aggregation aligns all traits on (FID, IID) - the
    full outer alignment of per-trait tables without a chain of joins."""
    keys = list(keys)
    traits = sorted(traits) if traits is not None else traits_present(pheno)
    wide = pheno.groupBy(*keys, "FID", "IID").pivot("trait", traits).agg(*[F.first(s).alias(s) for s in stats])
    # Spark names pivot columns "<value>_<alias>", or just "<value>" for a single aggregate
    name = (lambda t, s: f"`{t}_{s}`") if len(stats) > 1 else (lambda t, s: f"`{t}`")
    cols = [F.col(name(t, s)).alias(f"{t.replace(' ', '_')}.{s}") for t in traits for s in stats]
    return wide.select(*keys, "FID", "IID", *cols)
