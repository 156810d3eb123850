"""Raw-line hygiene before parsing (the same job, no shell pre-processing step).

Lines are read with ``spark.read.text`` (splittable, one row per line, file path kept), the
line rules run as filters, and surviving lines are parsed with ``from_csv`` (JVM side).
Rejected lines are returned as their own DataFrame so they can be counted or quarantined.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traitflow.operators.filters import computed
from traitflow.sources.readers import apply_null_tokens


def read_lines(spark: SparkSession, paths) -> DataFrame:
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file_path"))


def quoted_delimiter_pattern(sep: str) -> str:
    """A quoted field that contains the delimiter: ``<sep>"[^"]*<sep>``."""
    s = re.escape(sep) if sep != "\t" else "\\t"
    return f'{s}"[^"]*{s}'


def drop_quoted_delimiter_lines(lines: DataFrame, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): lines where a quoted field holds the delimiter are set aside."""
    bad = F.col("value").rlike(quoted_delimiter_pattern(sep))
    return lines.filter(~bad), lines.filter(bad)


def drop_unterminated_quote_lines(lines: DataFrame, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Same rule for tab files, where it catches a quote left open up to the next field."""
    return drop_quoted_delimiter_lines(lines, sep)


def read_placed_lines(spark: SparkSession, paths) -> DataFrame:
    """value, file_path, block (where its split starts in the file) and place (grows with the lines of a block)."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("place"))


def placed_records(lines: DataFrame) -> DataFrame:
    """Lines of ``read_placed_lines`` with ``record`` (its number in the file, from 0) and ``part`` of it: whole, first, inside or last.

    A record goes on to the next line while a quote is open. A line's number of quotes says whether it turns that over, and
    whether a quote is open where a block starts depends on all blocks before it. So blocks are summed up first: does the
    block turn it over, and how many records start in it if none is open at its start, and if one is. Two prefix
    sums over a file's blocks (a row each) give every block its start; the lines of a block are then scanned on their own."""
    per_block = Window.partitionBy("file_path", "block").orderBy("place")
    odd = F.pmod(F.length("value") - F.length(F.translate("value", '"', "")), F.lit(2))
    turned = F.coalesce(F.sum("odd").over(per_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = lines.withColumn("odd", odd).withColumn("turned", F.pmod(turned, F.lit(2)))        # by the lines before it in the block

    order = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = inside.groupBy("file_path", "block").agg(F.sum("odd").alias("odds"), F.sum(1 - F.col("turned")).alias("starts0"), F.sum("turned").alias("starts1"))
    blocks = blocks.withColumn("open", F.pmod(F.coalesce(F.sum("odds").over(order), F.lit(0)), F.lit(2)))
    starts = F.when(F.col("open") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum(starts).over(order), F.lit(0))).select(
        F.col("file_path").alias("_f"), F.col("block").alias("_b"), "open", "before")

    x = inside.join(blocks, (F.col("file_path") == F.col("_f")) & (F.col("block") == F.col("_b")))
    goes_on = F.pmod(F.col("turned") + F.col("open"), F.lit(2))             # a quote is open where the line starts
    x = x.withColumn("goes_on", goes_on)
    started = F.sum(1 - F.col("goes_on")).over(per_block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends_open = F.pmod(F.col("goes_on") + F.col("odd"), F.lit(2)) == 1
    part = (F.when((F.col("goes_on") == 0) & ~ends_open, "whole").when(F.col("goes_on") == 0, "first").when(ends_open, "inside").otherwise("last"))
    return x.select("value", "file_path", "block", "place", (F.col("before") + started - 1).alias("record"), part.alias("part"))


def broken_records(placed: DataFrame) -> DataFrame:
    """file_path, record, n_lines and text of the records that span several lines, put together again: what the line rules drop
    as separate lines. A record whose quote never closes has no last line and runs to the end of its file; only
    its first line is given."""
    many = placed.filter(F.col("part") != "whole").groupBy("file_path", "record").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max((F.col("part") == "last").cast("int")).alias("closed"))
    closed = many.filter("closed = 1").select(F.col("file_path").alias("_f"), F.col("record").alias("_r"), "n_lines")
    rows = placed.join(closed, (F.col("file_path") == F.col("_f")) & (F.col("record") == F.col("_r")))
    whole = rows.groupBy("file_path", "record", "n_lines").agg(F.array_sort(F.collect_list(F.struct("block", "place", "value"))).alias("l"))
    whole = whole.select("file_path", "record", "n_lines", F.array_join(F.col("l.value"), "\n").alias("text"))
    lost = many.filter("closed = 0").select(F.col("file_path").alias("_f"), F.col("record").alias("_r"))
    first = placed.filter("part = 'first'").join(lost, (F.col("file_path") == F.col("_f")) & (F.col("record") == F.col("_r")))
    return whole.unionByName(first.select("file_path", "record", F.lit(1).cast("long").alias("n_lines"), F.col("value").alias("text")))


def strip_double_quotes(lines: DataFrame) -> DataFrame:
    """Remove every double quote (single, doubled or tripled)."""
    return computed(lines.withColumn("value", F.replace("value", F.lit('"'), F.lit(""))), ["value"])


def delimiter_count(sep: str = "\t"):
    return F.length("value") - F.length(F.replace("value", F.lit(sep), F.lit("")) if len(sep) == 1 else F.translate("value", sep, ""))


def delimiter_count_profile(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """Number of non-blank lines per delimiter count."""
    return (lines.filter(F.col("value") != "")
            .groupBy(delimiter_count(sep).alias("n_delimiters")).agg(F.count("*").alias("n_lines")))


def keep_expected_width_lines(lines: DataFrame, sep: str, n: int) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): keep non-blank lines with exactly ``n`` delimiters."""
    nonblank = lines.filter(F.col("value") != "")
    ok = delimiter_count(sep) == n
    return nonblank.filter(ok), nonblank.filter(~ok)


def header_columns(lines: DataFrame, sep: str, must_contain: list[str] | None = None) -> list[str]:
    """Column names from the header line: the first line holding every name in ``must_contain``
    (one row is read; the header is a single bounded line)."""
    cand = lines.select("value")
    for name in must_contain or []:
        cand = cand.filter(F.col("value").contains(name))
    first = cand.first()
    if first is None:
        raise ValueError("no header line found")
    return first[0].split(sep)


def check_headers(lines: DataFrame, sep: str, columns: list[str], must_contain: list[str]) -> DataFrame:
    """``lines``, failing on a header line (one that holds every name) with other columns or another
    order than ``columns``: files of one source must agree."""
    header = F.lit(True)
    for name in must_contain:
        header = header & F.col("value").contains(name)
    other = header & (F.col("value") != F.lit(sep.join(columns)))
    return lines.withColumn("value", F.when(other, F.raise_error(F.concat(F.lit("files with different headers: "), F.col("value"))).cast("string"))
                            .otherwise(F.col("value")))


def parse_lines(lines: DataFrame, sep: str, columns: list[str], null_values=("",),
                header: bool = True, keep_file: bool = False) -> DataFrame:
    """Parse text lines into all-string columns; header lines (equal to the column names) drop."""
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    opts = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    # a generator, so that a line is parsed once and not again in every expression on one of its columns
    parsed = lines.select(F.inline(F.array(F.from_csv(F.col("value"), ddl, opts))), *(["file_path"] if keep_file else []))
    out = parsed.toDF(*columns, *(["file_path"] if keep_file else []))
    if header:
        out = out.filter(~F.coalesce(F.col(f"`{columns[0]}`") == columns[0], F.lit(False)))
    return apply_null_tokens(out, null_values)
