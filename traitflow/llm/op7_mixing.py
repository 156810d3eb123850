"""Mixing sources to target token weights by entropy balancing (JVM-side DataFrame code only).

Model. Every token of the corpus starts with mass 1. Among all nonnegative rates that give source
``s`` the target ``T_s`` of tokens, entropy balancing takes the one nearest to the start in
Kullback-Leibler divergence. Its convex dual is ``D(l) = sum_i size_i exp(l_s(i)) - sum_s T_s l_s``:
a document's rate is the exponential tilt ``exp(l_s)``. Newton steps ``l -= gradient / curvature``
run as DataFrame joins over the per-source token sums (both are sums over documents, taken once in
a map-side combined aggregation); the Hessian is diagonal because constraints do not overlap.
Steps above 1 are cut to 1, which keeps Newton's method convergent from ``l = 0``.

Rounding. Rates become whole copies by systematic rounding in the order (size, md5 of the id) in
each source: document number k takes ``floor(r k + u) - floor(r (k - 1) + u)`` copies. In size
order the error of a source's tokens telescopes to at most its largest document. What is left is made up
with the smallest documents, in the same order: one copy more (or less) each, as long as that brings the
source nearer to its target. Ranks and running sums come from a range partitioning over (source, size,
md5), so a source with a third of all rows spreads over many tasks; only one row per (partition,
source) is needed for the offsets.

Edge cases: null text has size 0; a null source is a source of its own, last in the order; a null
id sorts first among equals; repeated rows are separate documents; an empty table gives no rows;
sources with no tokens have target 0 and take 0. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from traitflow.llm import common as C

WEIGHTS = (3, 1, 2)     # by place in the source order, repeating
SHARE = 1.5             # tokens of the mix over tokens of the corpus
CAP = 2.0               # most copies of a document, and most tokens of a source over its size
PHASE = 0.3819660112501051  # u of the systematic rounding: no rational rate meets it
TOLERANCE = 1e-13
MAX_STEPS = 60


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: source, source_size, target. Fills by weight up to ``cap`` times the
    source's size: sources in the order of cap over weight; the first m are full, the rest share
    what is left by weight. The window runs over sources, not documents."""
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    every = W.partitionBy()
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights)) + 1)
    ranked = (per_source.select("source", "source_size", weight.alias("w"))
              .withColumn("top", F.lit(float(cap)) * F.col("source_size"))
              .withColumn("ratio", F.col("top") / F.col("w")))
    below = every.orderBy(F.col("ratio").asc(), F.col("source").asc_nulls_last())
    before = below.rowsBetween(W.unboundedPreceding, -1)
    level = ((F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    filled = (ranked.withColumn("level", level)
              # the level at which sources not yet full share: that of the first source whose cap is above it
              .withColumn("tau", F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(every)))
    return filled.select("source", "source_size",
                         F.when(F.col("source_size") == 0, F.lit(0.0))
                         .otherwise(F.least("top", F.coalesce(F.col("tau") * F.col("w"), F.col("top")))).alias("target"))


def tilted_rates(goals: DataFrame, tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS) -> DataFrame:
    """``goals`` (source, source_size, target) with the column ``rate`` = exp(dual)."""
    dual = C.written(goals.withColumn("dual", F.lit(0.0)), "mix-dual")
    for step in range(max_steps):
        mass = F.col("source_size") * F.exp("dual")
        gap = F.when((F.col("source_size") > 0) & (F.col("target") > 0), (mass - F.col("target")) / mass).otherwise(F.lit(0.0))
        worst = dual.agg(F.max(F.abs(gap))).first()[0]
        if worst is None or worst <= tolerance:
            break
        dual = dual.withColumn("dual", F.col("dual") - F.greatest(F.lit(-1.0), F.least(F.lit(1.0), gap)))
        if step % 8 == 7:  # keeps the plan short
            dual = C.written(dual, "mix-dual")
    return dual.withColumn("rate", F.when(F.col("target") > 0, F.least(F.exp("dual"), F.lit(CAP))).otherwise(F.lit(0.0))).drop("dual")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, keep: tuple = ()) -> DataFrame:
    """doc_id, size, source_size, target, rate, copies, taken, and the columns of ``keep``."""
    more = [F.struct(*keep).alias("_more")] if keep else []     # apart from this function's own names
    sizes = docs.select("doc_id", "source", C.n_words(F.col("text")).alias("size"), *more)
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # Range partitioning keeps a large source spread; written, so partition ids stay what they are.
    ordered = (sizes.withColumn("_place", place)
               .repartitionByRange(F.col("source").asc_nulls_first(), "size", "_place", "doc_id")
               .sortWithinPartitions(F.col("source").asc_nulls_first(), "size", "_place", "doc_id")
               .withColumn("_row", F.monotonically_increasing_id()).drop("_place"))
    ordered = C.written(ordered, "mix-order").withColumn("_part", F.shiftright("_row", 33))
    rates = C.written(tilted_rates(targets(ordered, weights, share, cap)), "mix-rates")
    parts = before(ordered.groupBy("_part", "source").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first")), "n")
    goals = rates.select(F.col("source").alias("gs"), "source_size", "target", "rate")
    ranked = (at_part(ordered, parts, "first", "before")
              .join(goals, F.col("source").eqNullSafe(F.col("gs")))
              .withColumn("_k", F.col("_row") - F.col("first") + F.col("before") + 1))
    steps = F.floor(F.col("rate") * F.col("_k") + PHASE) - F.floor(F.col("rate") * (F.col("_k") - 1) + PHASE)
    rounded = C.written(ranked.withColumn("copies", F.least(steps, F.lit(int(cap)))).drop("gs", "_k", "first", "before"), "mix-rounded")

    taken = rounded.groupBy(F.col("source").alias("es")).agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
    able = F.when(F.col("gap") > 0, F.col("copies") < int(cap)).otherwise(F.col("copies") > 0)
    open_ = rounded.join(C.written(taken, "mix-gap"), F.col("source").eqNullSafe(F.col("es"))).withColumn("w", F.when(able, F.col("size")).otherwise(F.lit(0)))
    parts = before(open_.groupBy("_part", "source").agg(F.sum("w").alias("n")), "n")
    inside = F.sum("w").over(W.partitionBy("source", "_part").orderBy("_row").rowsBetween(W.unboundedPreceding, 0))
    reach = at_part(open_.withColumn("inside", inside), parts, "before").withColumn("reach", F.col("inside") + F.col("before"))
    turn = (F.col("w") > 0) & (F.col("reach") - F.col("w") / 2 < F.abs("gap"))
    copies = F.col("copies") + F.when(turn, F.signum("gap").cast("long")).otherwise(F.lit(0))
    return (reach.withColumn("copies", copies)
            .select("doc_id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"), *[F.col("_more")[k].alias(k) for k in keep]))


def before(parts: DataFrame, what: str) -> DataFrame:
    """``parts`` (_part, source, ``what``) with ``before``, the sum over the source's earlier partitions."""
    return parts.withColumn("before", F.coalesce(F.sum(what).over(
        W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


def at_part(rows: DataFrame, parts: DataFrame, *columns: str) -> DataFrame:
    small = parts.select(F.col("_part").alias("_p"), F.col("source").alias("_s"), *columns)
    return rows.join(small, (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s"))).drop("_p", "_s")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(C.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM docs GROUP BY source),
total AS (SELECT 1.5 * sum(source_size) AS t FROM src),
-- a full source stays full: repeat sharing what is left among the others by weight
fill(step, source, source_size, w, is_full) AS (
  SELECT 0, source, source_size, w, false FROM src
  UNION ALL
  SELECT step + 1, source, source_size, w,
         is_full OR 2.0 * source_size < w * ((SELECT t FROM total) - coalesce(sum(CASE WHEN is_full THEN 2.0 * source_size END) OVER (), 0))
                    / sum(CASE WHEN NOT is_full THEN w END) OVER ()
  FROM fill WHERE step < 40),
goal AS (
  SELECT source, source_size, CASE WHEN is_full THEN 2.0 * source_size
         ELSE w * ((SELECT t FROM total) - coalesce(sum(CASE WHEN is_full THEN 2.0 * source_size END) OVER (), 0))
              / sum(CASE WHEN NOT is_full THEN w END) OVER () END AS target
  FROM fill WHERE step = 40),
ranked AS (
  SELECT d.doc_id, d.source, d.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS r,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5(d.doc_id::VARCHAR), d.doc_id) AS k
  FROM docs d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
rounded AS (
  SELECT *, floor(r * k + 0.3819660112501051) - floor(r * (k - 1) + 0.3819660112501051) AS copies FROM ranked),
gaps AS (SELECT *, target - sum(copies * size) OVER (PARTITION BY source) AS gap FROM rounded),
able AS (SELECT *, CASE WHEN CASE WHEN gap > 0 THEN copies < 2 ELSE copies > 0 END THEN size ELSE 0 END AS w FROM gaps),
reach AS (SELECT *, sum(w) OVER (PARTITION BY source ORDER BY k) AS reach FROM able)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (size * (copies + CASE WHEN w > 0 AND reach - w / 2 < abs(gap) THEN sign(gap) ELSE 0 END))::BIGINT AS taken
FROM reach
"""
