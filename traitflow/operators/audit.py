"""Row-count auditing and data-quality checks.

``audit_steps`` measures a whole chain of labelled filters in ONE aggregation pass (a running
AND of the predicates), instead of re-running the plan before and after every step.
``AuditLog`` attaches ``DataFrame.observe`` metrics so counts are collected by the job that
writes the result. Checks raise instead of printing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from traitflow.functions.scalars import round_half_away


class DataQualityError(ValueError):
    pass


def audit_steps(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """``(step, label, before, after, pct_change)`` for cumulative filters, one pass over ``df``."""
    aggs, cond = [F.count("*").alias("c0")], F.lit(True)
    for i, (_, pred) in enumerate(steps, start=1):
        cond = cond & F.coalesce(pred, F.lit(False))
        aggs.append(F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(f"c{i}"))
    counts = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(lbl).alias("label"),
                              F.col(f"c{i}").alias("before"), F.col(f"c{i + 1}").alias("after"))
                     for i, (lbl, _) in enumerate(steps)])
    out = counts.select(F.explode(rows).alias("r")).select("r.*")
    pct = F.when(F.col("before") > 0, round_half_away((F.col("after") - F.col("before")) * 100.0 / F.col("before"), 1))
    return out.withColumn("pct_change", pct)


Rules = list[tuple[str, Column]]


def first_failed(rules: Rules) -> Column:
    """Number (from 1) of the first rule that is not true for a row, in their order; 0 if all are. A rule that is null is
    not true."""
    out = F.lit(0)
    for i, (_, rule) in reversed(list(enumerate(rules, start=1))):
        out = F.when(~F.coalesce(rule, F.lit(False)), i).otherwise(out)
    return out


def traced(df: DataFrame, rules: Rules, col: str = "rule") -> DataFrame:
    """Every row with the number of the rule that drops it (0: kept); one pass, nothing is shuffled."""
    return df.withColumn(col, first_failed(rules))


def rule_counts(trace: DataFrame, rules: Rules, col: str = "rule") -> DataFrame:
    """``(step, label, before, after, pct_change)`` of the rules as successive filters, from one aggregation of the trace:
    a row that rule k drops has passed all before it."""
    dropped = trace.agg(*[F.count(F.when(F.col(col) == i, 1)).alias(f"d{i}") for i in range(len(rules) + 1)])
    left = F.lit(0)
    for i in range(len(rules) + 1):
        left = left + F.col(f"d{i}")
    steps = []
    for i, (label, _) in enumerate(rules, start=1):
        steps.append(F.struct(F.lit(i).alias("step"), F.lit(label).alias("label"), left.alias("before"), (left - F.col(f"d{i}")).alias("after")))
        left = left - F.col(f"d{i}")
    out = dropped.select(F.explode(F.array(*steps)).alias("r")).select("r.*")
    return out.withColumn("pct_change", F.when(F.col("before") > 0, round_half_away((F.col("after") - F.col("before")) * 100.0 / F.col("before"), 1)))


def quarantine(trace: DataFrame, rules: Rules, col: str = "rule") -> DataFrame:
    """The dropped rows with the number and label of the rule that dropped them."""
    labels = F.array(*[F.lit(label) for label, _ in rules])
    return trace.filter(F.col(col) > 0).withColumn("reason", F.element_at(labels, F.col(col)))


def audit_join(left: DataFrame, right: DataFrame, on, how: str, label: str = "join") -> tuple[DataFrame, DataFrame]:
    """The joined frame plus a long count table ``(label, side, rows)`` for left, right, result."""
    joined = left.join(right, on, how)
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(label).alias("label"), F.lit(side).alias("side"), "rows")
              for side, df in (("left", left), ("right", right), ("result", joined))]
    return joined, counts[0].unionByName(counts[1]).unionByName(counts[2])


def audit_unique(df: DataFrame, keys: list[str], label: str = "unique") -> DataFrame:
    """One row ``(label, before, after, pct_change)``: rows vs distinct ``keys`` (nulls equal)."""
    c = df.agg(F.count("*").alias("before"), F.countDistinct(F.struct(*keys)).alias("after"))
    pct = F.when(F.col("before") > 0, round_half_away((F.col("after") - F.col("before")) * 100.0 / F.col("before"), 1))
    return c.select(F.lit(label).alias("label"), "before", "after", pct.alias("pct_change"))


def _round1(v: float) -> float:
    """One decimal, half away from zero (same rule as the column helpers)."""
    import math
    return math.copysign(math.floor(abs(v) * 10 + 0.5) / 10, v)


class AuditLog:
    """Collects before/after counts through ``observe`` (no extra jobs)."""

    def __init__(self):
        self._steps: list[tuple[str, Observation, Observation]] = []

    def filter(self, df: DataFrame, cond: Column, label: str) -> DataFrame:
        before, after = Observation(f"{label}:before"), Observation(f"{label}:after")
        observed = df.observe(before, F.count(F.lit(1)).alias("n"))
        out = observed.filter(cond).observe(after, F.count(F.lit(1)).alias("n"))
        self._steps.append((label, before, after))
        return out

    def report(self, spark: SparkSession) -> DataFrame:
        rows = []
        for label, b, a in self._steps:
            nb, na = b.get["n"], a.get["n"]
            rows.append((label, nb, na, None if nb == 0 else _round1((na - nb) * 100.0 / nb)))
        return spark.createDataFrame(rows, "label string, before long, after long, pct_change double")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_dictionary_unique(df: DataFrame, keys: list[str] | None = None) -> None:
    keys = keys or df.columns
    bad = duplicates(df, keys).limit(20).collect()
    if bad:
        raise DataQualityError(f"duplicate dictionary rows on {keys}: {bad}")


def check_m1(df: DataFrame, keys: list[str]) -> None:
    """The right side of an m:1 join must be unique on its keys."""
    if duplicates(df, keys).limit(1).count():
        raise DataQualityError(f"right side not unique on {keys}")


def check_unique_ids(df: DataFrame, col: str) -> None:
    n, nd = df.agg(F.count(col), F.countDistinct(col)).first()
    if n != nd:
        raise DataQualityError(f"{col}: {n} non-null values but {nd} distinct")
