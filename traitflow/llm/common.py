"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.session import staging_path

# White space of the word rule [^\x20\x09-\x0D]+ (fixed value).
WORD_SPACE = " \t\n\x0b\x0c\r"
NOT_WORD = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage ends there, and the
    rows survive the loss of any executor."""
    spark = df.sparkSession
    path = staging_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once per row. Catalyst may inline a projected column into
    a lambda, which would evaluate it once per element; a lambda variable is never inlined."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD), lambda w: w != F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def row_key() -> Column:
    """Key of a document row by its contents: equal rows (same id and text) share results, rows with the
    same id and other text do not."""
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("h"))


def smallest_hashes(h: Column, total: int, want: int) -> Column:
    """True for the rows whose 64-bit hash ``h`` lies in the lowest part of its range that holds about twice
    ``want`` of ``total`` rows. Before an ordered limit it bounds what all partitions send to it together."""
    share = min(1.0, 2 * want / max(total, 1))
    return h <= F.lit(min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))).cast("long")
