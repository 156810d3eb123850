"""Interval algebra for hospital stays.

``split_and_remerge_intervals`` turns overlapping labelled intervals into disjoint segments
carrying the set of labels that cover them, then merges touching segments with equal label
sets. It is computed as a sweep line, not a self join:

  1. each interval emits +1 at its start and -1 at its end for each of its labels (intervals
     without a positive length only add their boundaries);
  2. events are summed per (id, boundary) - a partial aggregation, so repeated stays collapse
     before the shuffle;
  3. one running sum per id ordered by boundary gives, for the elementary segment starting at
     each boundary, how many intervals of each label cover it;
  4. covered segments are chained into islands: a label-set change, including to or from an
     uncovered gap, starts a new island, which ends at the next change (a second window over the
     changes only).

Both windows are partitioned by id only, so there is one shuffle
(on id) for the whole operator; per-id rows are bounded by distinct boundaries (at most two
per calendar day), never by the raw row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traitflow import schema as S
from traitflow.functions import scalars as X
from traitflow.functions.regions import canonical_regions
from traitflow.session import spread

_FLAGS = ["_a", "_bb", "_ba"]


def _w():
    return Window.partitionBy("_id").orderBy("_x")


def _run():
    return _w().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def add_buffers(df: DataFrame, before: int = S.BUFFER_BEFORE_DAYS, after: int = S.BUFFER_AFTER_DAYS,
                pad_before: int = 0, pad_after: int = 0, id_col: str = "pseudo_nhs_number",
                start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Each stay -> three rows: buffer_before [s-(b+p), s-p), the stay [s, e], buffer_after
    [e+p, e+p+b), each tagged with a one-label ``region_types`` array."""
    s, e = F.col(start_col), F.col(end_col)
    parts = F.array(
        F.struct(F.date_sub(s, before + pad_before).alias("s"), F.date_sub(s, pad_before).alias("e"),
                 F.lit("buffer_before").alias("r")),
        F.struct(s.alias("s"), e.alias("e"), F.lit("APC").alias("r")),
        F.struct(F.date_add(e, pad_after).alias("s"), F.date_add(e, pad_after + after).alias("e"),
                 F.lit("buffer_after").alias("r")),
    )
    return (df.select(F.col(id_col).alias(id_col), F.explode(parts).alias("_p"))
            .select(id_col, F.col("_p.s").alias("start_date"), F.col("_p.e").alias("end_date"),
                    F.array(F.col("_p.r")).alias("region_types")))


def _coded_points(df: DataFrame, id_col: str, start_col: str, end_col: str, regions_col: str) -> DataFrame:
    """Boundaries ``(_id, _x)`` with their label changes ``_d0..``, ``_code`` (3-bit label set from here on, 0 = uncovered) and
    ``_pcode`` (label set up to here, 0 at an id's first boundary).

    One running sum per label: the count up to a boundary is the count from there on without the boundary's own change.
    Rows without an id belong to nobody and are left out (they would be one group of any size)."""
    s, e, r = F.col(start_col), F.col(end_col), F.col(regions_col)
    valid = e.isNotNull() & (e > s)
    labels = range(len(S.REGION_ORDER))
    deltas = [F.when(valid & F.array_contains(r, lbl), 1).otherwise(0) for lbl in S.REGION_ORDER]

    # Both events of an interval come from one pass over the input (no union of two scans).
    events = (df.filter(F.col(id_col).isNotNull() & s.isNotNull())
              .select(F.col(id_col).alias("_id"),
                      F.explode(F.array(F.struct(s.alias("_x"), *[d.alias(f"_d{i}") for i, d in enumerate(deltas)]),
                                        F.struct(e.alias("_x"), *[(-d).alias(f"_d{i}") for i, d in enumerate(deltas)])))
                      .alias("_ev"))
              .select("_id", "_ev.*")
              .filter(F.col("_x").isNotNull()))
    points = events.groupBy("_id", "_x").agg(*[F.sum(f"_d{i}").alias(f"_d{i}") for i in labels])
    counted = points.select("*", *[F.sum(f"_d{i}").over(_run()).alias(f"_c{i}") for i in labels])

    def code(count):
        return sum((F.when(count(i) > 0, F.lit(1 << i)).otherwise(F.lit(0)) for i in labels), F.lit(0))
    return counted.select("_id", "_x", code(lambda i: F.col(f"_c{i}")).alias("_code"),
                          code(lambda i: F.col(f"_c{i}") - F.col(f"_d{i}")).alias("_pcode"))


def sweep_segments(df: DataFrame, id_col: str = "pseudo_nhs_number", start_col: str = "start_date",
                   end_col: str = "end_date", regions_col: str = "region_types") -> DataFrame:
    """Every elementary segment between consecutive boundaries, covered or not:
    ``(_id, _x, _e, _code, _new, _g)`` where ``_code`` is the 3-bit label set (0 = uncovered),
    ``_new`` marks a covered segment that starts an island and ``_g`` numbers the islands.

    Two window passes: (1) each label's running count, (2) next boundary and a running
    count of island starts. Uncovered segments stay until the end, so a gap is just a change of
    label set and needs no extra comparison."""
    coded = _coded_points(df, id_col, start_col, end_col, regions_col)
    starts = ((F.col("_code") != 0) & (F.col("_pcode") != F.col("_code"))).cast("int")
    return coded.select("_id", "_x", "_code", starts.alias("_new")).select(
        "_id", "_x", F.lead("_x").over(_w()).alias("_e"), "_code", "_new", F.sum("_new").over(_run()).alias("_g"))


def covered_segments(df: DataFrame, id_col: str = "pseudo_nhs_number", start_col: str = "start_date",
                     end_col: str = "end_date", regions_col: str = "region_types") -> DataFrame:
    """Covered elementary segments with their label set, island starts and island numbers:
    ``(_id, _x, _e, _code, _new, _g, _a, _bb, _ba)``."""
    segs = sweep_segments(df, id_col, start_col, end_col, regions_col)
    segs = segs.filter(F.col("_e").isNotNull() & (F.col("_code") != 0))
    return segs.select("*", *[((F.col("_code").bitwiseAND(F.lit(1 << i))) != 0).alias(f)
                              for i, f in enumerate(_FLAGS)])


def islands_min_max(islands: DataFrame, id_col: str = "pseudo_nhs_number", start_col: str = "start_date",
                    end_col: str = "end_date", regions_col: str = "region_types") -> DataFrame:
    """One row per island: min start, max end and its region list in canonical order."""
    merged = islands.groupBy("_id", "_g", "_code").agg(F.min("_x").alias("_s"), F.max("_e").alias("_e"))
    return _labelled(merged, id_col, start_col, end_col, regions_col)


def _labelled(merged: DataFrame, id_col: str, start_col: str, end_col: str, regions_col: str) -> DataFrame:
    flags = [(F.col("_code").bitwiseAND(F.lit(1 << i))) != 0 for i in range(3)]
    return merged.select(
        F.col("_id").alias(id_col), F.col("_s").alias(start_col), F.col("_e").alias(end_col),
        canonical_regions(*flags).alias(regions_col))


def split_and_remerge_intervals(df: DataFrame, id_col: str = "pseudo_nhs_number",
                                start_col: str = "start_date", end_col: str = "end_date",
                                regions_col: str = "region_types") -> DataFrame:
    """Disjoint, maximal segments ``(id, start, end, region_types)`` (see module doc).

    An island reaches from a boundary at which the label set changes to the next such boundary, so only these
    are kept and nothing is aggregated again. All windows share (partition by id, order by boundary): one sort serves them."""
    points = _coded_points(df, id_col, start_col, end_col, regions_col)
    changes = points.filter(F.col("_code") != F.col("_pcode"))
    islands = changes.select("_id", F.col("_x").alias("_s"), F.lead("_x").over(_w()).alias("_e"), "_code").filter(F.col("_code") != 0)
    return _labelled(islands, id_col, start_col, end_col, regions_col)


def boundaries(df: DataFrame, id_col: str = "pseudo_nhs_number", start_col: str = "start_date",
               end_col: str = "end_date") -> DataFrame:
    """Distinct non-null (id, boundary) from the start and end columns (unpivot + distinct)."""
    long = df.select(id_col, start_col, end_col).unpivot(id_col, [start_col, end_col], "kind", "boundary")
    return long.filter(F.col("boundary").isNotNull()).select(id_col, "boundary").distinct()


def elementary_segments(df: DataFrame, id_col: str = "pseudo_nhs_number", start_col: str = "start_date",
                        end_col: str = "end_date") -> DataFrame:
    """Consecutive boundary pairs per id: ``(id, start, end)`` with end = next boundary."""
    b = boundaries(df, id_col, start_col, end_col)
    nxt = F.lead("boundary").over(Window.partitionBy(id_col).orderBy("boundary"))
    return (b.select(id_col, F.col("boundary").alias(start_col), nxt.alias(end_col))
            .filter(F.col(end_col).isNotNull()))


def admission_windows(stays: DataFrame, min_days: int = S.MIN_ADMISSION_DAYS,
                      before: int = S.BUFFER_BEFORE_DAYS, after: int = S.BUFFER_AFTER_DAYS,
                      id_col: str = "pseudo_nhs_number",
                      admission_col: str = "hospital_admission_datetime",
                      discharge_col: str = "hospital_discharge_datetime") -> DataFrame:
    """Stays -> buffered, disjoint region segments ``(id, start_date, end_date, region_types)``.

    Merge overlapping stays, round both ends to the nearest day, keep stays longer than
    ``min_days`` days, add the buffers, then split and re-merge into labelled segments.
    Stays are dealt by id once, to partitions that grow in number with the input.
    """
    stays = spread(stays.filter(F.col(id_col).isNotNull()).select(id_col, admission_col, discharge_col), id_col).withColumn(
        "region_types", F.array(F.lit("APC")))
    merged = split_and_remerge_intervals(stays, id_col, admission_col, discharge_col)
    days = (merged
            .select(id_col, X.round_to_day(admission_col).alias("start_date"),
                    X.round_to_day(discharge_col).alias("end_date"))
            .filter(F.datediff("end_date", "start_date") > min_days))
    return split_and_remerge_intervals(add_buffers(days, before, after, id_col=id_col), id_col)


def admission_timeline(segments: DataFrame, id_col: str = "pseudo_nhs_number") -> DataFrame:
    """Per segment: start, end, length in days and the labels as text (data behind a timeline)."""
    return segments.select(id_col, "start_date", "end_date",
                           F.datediff("end_date", "start_date").alias("days"),
                           F.array_join("region_types", ",").alias("regions"))


def admission_length_histogram(segments: DataFrame, bins: int = 50) -> DataFrame:
    """Counts of segment length in ``bins`` equal-width bins over [min, max] length."""
    lengths = segments.select(F.datediff("end_date", "start_date").alias("days"))
    lo, hi = lengths.agg(F.min("days"), F.max("days")).first()  # two scalars
    if lo is None:
        return lengths.select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_start"),
                              F.lit(0.0).alias("bin_end"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (hi - lo) / bins
    idx = (F.least(F.floor((F.col("days") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
           if width > 0 else F.lit(0)).cast("int")
    return (lengths.select(idx.alias("bin"))
            .groupBy("bin").agg(F.count("*").alias("n"))
            .select("bin", (F.lit(float(lo)) + F.col("bin") * F.lit(float(width))).alias("bin_start"),
                    (F.lit(float(lo)) + (F.col("bin") + 1) * F.lit(float(width))).alias("bin_end"), "n"))
