"""Writers. Every output is written by the executors in one distributed pass: no driver
collects. Per-trait files come from ``partitionBy``; rows are first
rebalanced on (setting, trait): hashed so each trait lands in few files, with AQE splitting
the partition of a dominant trait into several tasks and merging small ones.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_trait(df: DataFrame, path: str, keys=("setting", "trait"), fmt: str = "csv") -> None:
    """One folder per (setting, trait), CSV with header (or parquet)."""
    w = df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_tsv(df: DataFrame, path: str, null: str = "NA", partition_by: list[str] | None = None) -> None:
    """Tab-separated text with a header; nulls written as ``null``."""
    w = df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", null) \
        .option("emptyValue", "")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_named_by_trait(df: DataFrame, path: str, traits: list[str], values: list[str], null: str = "NA") -> None:
    """One folder per trait (and setting) whose value columns are headed ``<trait>.<value>``. ``df`` is a stage
    partitioned by trait, so each trait's job reads its own files; the list is bounded by the dictionary."""
    for t in traits:
        named = t.replace(" ", "_")
        rows = df.filter(F.col("trait") == t).select("setting", "FID", "IID", *[F.col(v).alias(f"{named}.{v}") for v in values])
        write_tsv(rows, f"{path}/trait={quote(named)}", null, partition_by=["setting"])


def write_counts(df: DataFrame, path: str) -> None:
    """A small count table as CSV and as Parquet side by side."""
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    df.write.mode("overwrite").parquet(f"{path}/parquet")


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Materialise a stage as Parquet (cuts lineage; survives executor loss)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stage(spark: SparkSession, df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    write_stage(df, path, partition_by)
    return read_stage(spark, path)
