"""Delimited readers: explicit schemas, everything read as text, declared casts later.

No schema inference anywhere (one pass over the data, no type guessing on messy extracts).
Quotes follow RFC 4180 (a doubled quote inside a quoted field), as in the modelled reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _reader(spark: SparkSession, sep: str, header: bool):
    return (spark.read.option("sep", sep).option("header", header).option("inferSchema", False)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def apply_null_tokens(df: DataFrame, null_values: list[str] | tuple[str, ...]) -> DataFrame:
    """Turn the given tokens (and empty text) into nulls, in every column."""
    tokens = [v for v in null_values if v != ""]
    if not tokens:
        return df
    return df.select(*[F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string"))
                       .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_raw(spark: SparkSession, paths: str | list[str], sep: str = ",", null_values=("",),
             header: bool = True, columns: list[str] | None = None, rename_all: list[str] | None = None,
             file_col: str | None = None, exclude_files: list[str] | None = None) -> DataFrame:
    """All-string delimited read.

    * ``columns``: positional names for a file whose header line is skipped (header=True) or
      that has none (header=False);
    * ``rename_all``: read the header, then rename every column by position;
    * ``file_col``: keep the source file path in this column;
    * ``exclude_files``: file names to leave out. A dataset written by Spark is a folder of part
      files; its name is the folder's, so a name matches the file or its parent folder.
    """
    reader = _reader(spark, sep, header)
    if columns is not None:
        reader = reader.schema(string_schema(columns))
    else:
        # the names come from one file: a file whose header differs fails the job instead of
        # having its columns taken in another file's order
        reader = reader.option("enforceSchema", False)
    df = reader.csv(paths)
    if file_col or exclude_files:
        df = df.withColumn("_file_path", F.col("_metadata.file_path")) \
               .withColumn("_file_name", F.col("_metadata.file_name"))
        if exclude_files:
            parent = F.element_at(F.split(F.col("_file_path"), "/"), -2)
            names = list(exclude_files)
            df = df.filter(~F.col("_file_name").isin(names) & ~F.coalesce(parent.isin(names), F.lit(False)))
        df = df.drop("_file_name")
        df = df.withColumnRenamed("_file_path", file_col) if file_col else df.drop("_file_path")
    if rename_all is not None:
        keep = [c for c in df.columns if c != file_col]
        if len(keep) != len(rename_all):
            raise ValueError(f"rename_all has {len(rename_all)} names for {len(keep)} columns")
        df = df.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(keep, rename_all)],
                       *([file_col] if file_col else []))
    return apply_null_tokens(df, null_values)


def read_typed(spark: SparkSession, paths, schema: T.StructType, sep: str = "|", header: bool = True) -> DataFrame:
    """Read with a declared schema (instead of inferring types)."""
    return _reader(spark, sep, header).schema(schema).csv(paths)
