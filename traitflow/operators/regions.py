"""Reading dates -> hospital regions.

``range_join_regions`` joins points with the intervals that hold them through a dyadic index: days are cut
into buckets of ``bucket_days``; an interval is filed under at most two nodes per level of the binary tree over the
buckets (an interval of a few buckets under these themselves), and a point looks at one node a level. Interval rows
grow with the logarithm of the length, so an open or far end costs some thirty rows, and intervals may overlap.
Points look only at levels that hold an interval (a scalar subquery of the same job).

``add_region_types`` keeps every reading exactly once. Its right sides have one row per key by construction: the
segments of an (id, bucket), or the long segments of an id, in one array. A reading's hits are counted in its own row,
and a second hit fails the job: the m:1 rule is checked by the join itself, with no pass of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitflow.functions import regions as R
from traitflow.functions import scalars as X

DEFAULT_BUCKET_DAYS = 32
SHORT_BUCKETS = 8       # intervals of so many buckets are filed under each of them
LEVELS = 22             # of the tree: 2 ** 21 buckets, more than the days that a date can hold


def _bucket(c, days: int):
    return F.floor(X.epoch_day(c) / F.lit(days)).cast("long")


def _span(bucket_days: int) -> tuple[Column, Column]:
    """First bucket of an interval and the first one after it."""
    return _bucket(F.col("start_date"), bucket_days), _bucket(F.date_sub(F.col("end_date"), 1), bucket_days) + 1


def _half(c: Column, level: Column, up: bool) -> Column:
    """``c / 2 ** level`` as an integer, rounded up or down (exact: dates and powers of two fit a double)."""
    power = F.pow(F.lit(2.0), level)
    return (F.ceil(c / power) if up else F.floor(c / power)).cast("long")


def _placed(intervals: DataFrame, bucket_days: int) -> tuple[DataFrame, Column]:
    """Intervals of a positive length with ``_lo`` and ``_hi``, their buckets, and whether these are few."""
    lo, hi = _span(bucket_days)
    placed = intervals.filter(F.col("end_date") > F.col("start_date")).withColumn("_lo", lo).withColumn("_hi", hi)
    return placed, F.col("_hi") - F.col("_lo") <= SHORT_BUCKETS


def _ends(level: Column) -> tuple[Column, Column, Column, Column]:
    """Of an interval at a level: its first and last node there, and whether it is filed under each of them."""
    left, right = _half(F.col("_lo"), level, True), _half(F.col("_hi"), level, False)
    some = left < right
    return left, right - 1, some & (F.pmod(left, F.lit(2)) == 1), some & (F.pmod(right, F.lit(2)) == 1)


def used_levels(intervals: DataFrame, bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """One row: the levels that hold an interval (null without intervals), one bit a level, or-ed: nothing is exploded,
    and a distinct below is not run for it (bits of repeated rows are the same)."""
    placed, few = _placed(intervals, bucket_days)

    def bit(level):
        _, _, at_left, at_right = _ends(level)
        return F.when(at_left | at_right, F.pow(F.lit(2.0), level).cast("long")).otherwise(F.lit(0).cast("long"))

    levels = F.sequence(F.lit(0), F.lit(LEVELS))
    bits = F.when(few, F.lit(1).cast("long")).otherwise(F.aggregate(F.transform(levels, bit), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)))
    return placed.agg(F.bit_or(bits).alias("_bits")).select(F.filter(levels, lambda level: F.getbit("_bits", level) == 1).alias("_used"))


def interval_nodes(intervals: DataFrame, bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Every interval (``start_date``, ``end_date``) once per node that it is filed under: ``_level``, ``_node``.
    Intervals without a positive length are in no node."""
    placed, few = _placed(intervals, bucket_days)
    node = lambda level, at: F.struct(level.cast("int").alias("level"), at.cast("long").alias("node"))
    short = F.transform(F.sequence("_lo", F.col("_hi") - 1), lambda b: node(F.lit(0), b))

    def at_level(level):
        left, right, at_left, at_right = _ends(level)
        return F.array_compact(F.array(F.when(at_left, node(level, left)), F.when(at_right, node(level, right))))

    cover = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at_level))
    found = placed.withColumn("_at", F.explode(F.when(few, short).otherwise(cover)))
    return found.withColumn("_level", F.col("_at.level")).withColumn("_node", F.col("_at.node")).drop("_at", "_lo", "_hi")


def range_join_regions(points: DataFrame, segments: DataFrame, id_col: str = "pseudo_nhs_number",
                       date_col: str = "test_date", bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Points ``(id, date, ...)`` joined to every segment whose ``[start_date, end_date)`` holds
    the date. Adds ``start_date``, ``end_date`` and ``region_types``."""
    segs = segments.select(F.col(id_col).alias("_sid"), "start_date", "end_date", "region_types")
    nodes = interval_nodes(segs, bucket_days)
    used = used_levels(segs, bucket_days).scalar()      # at most LEVELS + 1 numbers
    pts = points.withColumn("_pl", F.explode(used)).withColumn("_pn", _half(_bucket(F.col(date_col), bucket_days), F.col("_pl"), False))
    cond = ((F.col(id_col) == F.col("_sid")) & (F.col("_pl") == F.col("_level")) & (F.col("_pn") == F.col("_node"))
            & (F.col(date_col) >= F.col("start_date")) & (F.col(date_col) < F.col("end_date")))
    return pts.join(nodes, cond).drop("_sid", "_pl", "_pn", "_level", "_node")


def region_lookup(readings: DataFrame, segments: DataFrame, id_col: str = "pseudo_nhs_number",
                  date_col: str = "test_date") -> DataFrame:
    """Distinct (id, date) of the readings that fall in a region, with their ``region_types``.

    The distinct runs first (as an aggregation, so repeated dates collapse map-side), which
    shrinks the range join to at most one row per person-day."""
    dates = readings.select(id_col, date_col).distinct()
    return range_join_regions(dates, segments, id_col, date_col).select(id_col, date_col, "region_types")


def _only(n: Column, value: Column, id_col: str, date_col: str) -> Column:
    """``value``, unless ``n`` segments met the reading and these are several."""
    text = F.concat(F.lit("several segments hold one reading: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(" "),
                    F.coalesce(F.col(date_col).cast("string"), F.lit("null")))
    return F.when(n > 1, F.raise_error(text)).otherwise(value)


def join_regions_m1(readings: DataFrame, lookup: DataFrame, id_col: str = "pseudo_nhs_number",
                    date_col: str = "test_date") -> DataFrame:
    """Left join of the lookup onto readings on (id, date), m:1: the lookup is reduced to one row per key that
    carries its number of rows, and a reading that meets a key with several fails the job. A null
    ``region_types`` means outside every region."""
    key = [F.col(id_col).alias("_lid"), F.col(date_col).alias("_ld")]
    one = lookup.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("region_types").alias("_r"))
    joined = readings.join(one, (F.col(id_col) == F.col("_lid")) & (F.col(date_col) == F.col("_ld")), "left")
    return joined.select(*readings.columns, _only(F.coalesce("_n", F.lit(0)), F.col("_r"), id_col, date_col).alias("region_types"))


def add_region_types(readings: DataFrame, segments: DataFrame, id_col: str = "pseudo_nhs_number",
                     date_col: str = "test_date", via_lookup: bool = False,
                     bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Readings + ``region_types`` (null outside every region); the row count is unchanged, and a reading that
    meets several segments fails the job.

    Default: left joins straight from the readings, on (id, bucket) for short segments and on id for the few long
    ones (segments of one id are disjoint: a century holds some 140 of them). ``via_lookup``: distinct (id, date)
    first, range join, then join back - better when the readings repeat each person-day many times (raw combo rows)."""
    if via_lookup:
        return join_regions_m1(readings, region_lookup(readings, segments, id_col, date_col), id_col, date_col)
    lo, hi = _span(bucket_days)
    segs = (segments.filter(F.col("end_date") > F.col("start_date"))
            .select(F.col(id_col).alias("_sid"), F.struct("start_date", "end_date", "region_types").alias("_s"), lo.alias("_lo"), hi.alias("_hi")))
    is_long = F.col("_hi") - F.col("_lo") > SHORT_BUCKETS
    short = (segs.filter(~is_long).select("_sid", "_s", F.explode(F.sequence("_lo", F.col("_hi") - 1)).alias("_b"))
             .groupBy("_sid", "_b").agg(F.collect_list("_s").alias("_short")))
    long = segs.filter(is_long).groupBy(F.col("_sid").alias("_lid")).agg(F.collect_list("_s").alias("_long"))
    joined = (readings.withColumn("_pb", _bucket(F.col(date_col), bucket_days))
              .join(short, (F.col(id_col) == F.col("_sid")) & (F.col("_pb") == F.col("_b")), "left")
              .join(long, F.col(id_col) == F.col("_lid"), "left"))
    none = F.array().cast(segs.select(F.array("_s")).schema[0].dataType)
    holds = lambda s: (F.col(date_col) >= s["start_date"]) & (F.col(date_col) < s["end_date"])
    hits = F.concat(F.filter(F.coalesce("_short", none), holds), F.filter(F.coalesce("_long", none), holds))
    found = joined.withColumn("_hits", hits)
    return found.select(*readings.columns, _only(F.size("_hits"), F.get("_hits", F.lit(0))["region_types"], id_col, date_col).alias("region_types"))


def classify_regions(df: DataFrame, regions_col: str = "region_types") -> DataFrame:
    """Add the eleven boolean region categories (never null)."""
    return df.select("*", *[R.category(regions_col, c).alias(c) for c in R.CATEGORIES])


def setting_split(df: DataFrame, regions_col: str = "region_types") -> DataFrame:
    """One row per (reading, setting): every reading is in ``all`` and in exactly one of
    ``in_hospital`` / ``out_hospital``. One pass instead of one filter per setting."""
    return df.withColumn("setting", F.explode(R.settings_of(regions_col)))


def region_subset_table(spark) -> DataFrame:
    """The eight possible region lists (including null) with their eleven categories."""
    rows = [(None,), (["APC"],), (["buffer_before"],), (["buffer_after"],), (["APC", "buffer_before"],),
            (["APC", "buffer_after"],), (["buffer_before", "buffer_after"],),
            (["APC", "buffer_before", "buffer_after"],)]
    return classify_regions(spark.createDataFrame(rows, "region_types array<string>"))
