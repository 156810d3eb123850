"""Deduplication and source merging.

Every dedup is an aggregation (not a window): exact copies collapse map-side before the
shuffle, so a reading copied millions of times never lands whole in one task. Survivors are
chosen by a fixed order, so results repeat from run to run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitflow import schema as S


def provenance_rank(order: list[str] | None, col: str = "provenance") -> Column:
    """Position of the provenance in ``order`` (unknown ones last, then by name)."""
    if not order:
        return F.lit(0)
    pos = F.array_position(F.array(*[F.lit(p) for p in order]), F.col(col))
    return F.when(pos > 0, pos).otherwise(F.lit(len(order) + 1))


def dedup_subset(df: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """One row per ``keys``: the row that is smallest by ``order`` then by the other columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order_cols = [F.col(o) if isinstance(o, str) else o for o in (order or [])]
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order_cols)] + [F.col(c) for c in rest]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_w"))
    return picked.select(*keys, *[F.col("_w")[c].alias(c) for c in rest]).select(*df.columns)


def survivor_code(order: list[str], sources: list[str] = S.SOURCE_OPTIONS):
    """Integer code ``rank * n_sources + source index``; values outside the closed sets fail
    the job (as the modelled closed enums do)."""
    pos = F.array_position(F.array(*[F.lit(p) for p in order]), F.col("provenance"))
    src = F.array_position(F.array(*[F.lit(x) for x in sources]), F.col("source"))
    bad = F.raise_error(F.concat(F.lit("provenance/source outside the closed set: "),
                                 F.coalesce(F.col("provenance"), F.lit("null")), F.lit("/"),
                                 F.coalesce(F.col("source"), F.lit("null")))).cast("int")
    return F.when((pos > 0) & (src > 0), (pos - 1) * len(sources) + (src - 1)).otherwise(bad)


def dedup_readings(df: DataFrame, provenance_order: list[str] | None = None) -> DataFrame:
    """Unique on the five content columns; the survivor is the earliest provenance in order.

    With a provenance order the survivor is one integer code, so the step is a fixed-width
    ``min`` hash aggregation with map-side combine; without one, the smallest
    (provenance, source) wins."""
    if not provenance_order:
        return dedup_subset(df, S.READING_KEY, ["provenance", "source"])
    return named(df.groupBy(*S.READING_KEY).agg(F.min(survivor_code(provenance_order)).alias("_code")), provenance_order)


def named(best: DataFrame, provenance_order: list[str]) -> DataFrame:
    """Readings with the provenance and source that their ``_code`` stands for."""
    n = len(S.SOURCE_OPTIONS)
    order = F.array(*[F.lit(p) for p in provenance_order])
    sources = F.array(*[F.lit(x) for x in S.SOURCE_OPTIONS])
    return best.select(*S.READING_KEY,
                       F.element_at(order, (F.floor(F.col("_code") / n) + 1).cast("int")).alias("provenance"),
                       F.element_at(sources, (F.col("_code") % n + 1).cast("int")).alias("source"))


def dedup_constant_source(df: DataFrame, provenance: str, source: str) -> DataFrame:
    """Dedup of the rows of one source (provenance and source are constants there): a distinct
    on the key columns (hash aggregation), then the constants."""
    return (df.select(*S.READING_KEY).distinct()
            .select(*S.READING_KEY, F.lit(provenance).alias("provenance"), F.lit(source).alias("source")))


def dedup_full_row(df: DataFrame) -> DataFrame:
    return df.distinct()


def union_sources(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def merge(dfs: list[DataFrame], provenance_order: list[str] | None = None) -> DataFrame:
    """Concatenate sources and dedup once (dedup is associative on the content key, so one
    dedup at the end equals the modelled dedup after every pairwise merge)."""
    return dedup_readings(union_sources(dfs), provenance_order)
