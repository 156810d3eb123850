"""Quality rules with risk-controlled thresholds (JVM-side DataFrame code only).

Each rule is a share between 0 and 1 that is large in bad text. Its cutoff in a stratum (language)
is chosen on labelled documents so that the rule rejects good documents there (label 1) with a
probability of at most ``alpha``, at confidence ``1 - delta`` for all rules and strata together:

* cutoffs of a per-mille grid are tested from the loosest to the strictest (fixed-sequence
  testing, so the grid costs no correction); a cutoff with ``k`` of ``n`` good documents above it
  passes if ``P(Binomial(n, alpha) <= k) <= delta / (rules * strata)``, the exact
  (Clopper-Pearson) bound with Bonferroni's correction over rules and strata;
* among the cutoffs that pass, the one that separates the labels best (share of bad documents
  rejected less share of good ones) is taken, the loosest of equals, and only if it separates at
  all. A stratum with too few labelled documents gets no cutoff, hence no rejections.

Labels are shared holdouts: the rules themselves have nothing fitted, so all labelled documents
serve. The histogram (stratum, rule, bin) has at most 1001 bins a group, built by a map-side
combined aggregation; windows run over bins, never over documents.

Edge cases: null or empty text has no words, fails the base rule and is not kept; null language is
a stratum; null ids are kept as rows and match no label; several labels of one id count one each
for every row of that id; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from traitflow.llm import common as C

SYMBOLS = "#*$%&|<>"      # fixed by the contract
MIN_WORDS = 50
ALPHA = 0.005             # false rejections of good documents, per rule and stratum
DELTA = 0.05              # chance that any of these bounds fails
MIN_GAIN = 0.001          # a cutoff must reject this much more of the bad than of the good
POSITION_BITS = 20


def repeat_words(words: Column) -> Column:
    """Number of words inside 3-word windows that occur at least twice in the array.

    One sort of the windows' hashes instead of a hash map: a hash and its position share a long
    (44 + 20 bits, neighbours compared by the whole hash), or a struct in texts of 2^20 words and more."""
    def hashes(w):
        return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2]))

    low = (1 << POSITION_BITS) - 1

    def packed_places(h):
        keys = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
        at = lambda k: k.bitwiseAND(F.lit(low)).cast("int")
        return C.let(keys, lambda s: F.transform(F.filter(s, lambda x, i: (
            ((i > 0) & (h[at(x)] == h[at(s[F.greatest(i - 1, F.lit(0))])]))
            | ((i < F.size(s) - 1) & (h[at(x)] == h[at(s[F.least(i + 1, F.size(s) - 1)])])))), at))

    def wide_places(h):
        keys = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return C.let(keys, lambda s: F.transform(F.filter(s, lambda x, i: (
            ((i > 0) & (x["h"] == s[F.greatest(i - 1, F.lit(0))]["h"]))
            | ((i < F.size(s) - 1) & (x["h"] == s[F.least(i + 1, F.size(s) - 1)]["h"])))), lambda x: x["i"]))

    def covered(places):  # windows are 3 words long: each covers 3 words or up to the next one
        return C.let(F.sort_array(places), lambda q: F.aggregate(
            F.transform(q, lambda x, i: F.when(i < F.size(q) - 1, F.least(F.lit(3), q[F.least(i + 1, F.size(q) - 1)] - x)).otherwise(3)),
            F.lit(0), lambda a, b: a + b))

    def count(w):
        return C.let(hashes(w), lambda h: covered(F.when(F.size(h) <= low, packed_places(h)).otherwise(wide_places(h))))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(count(words)).cast("long")


def measures(docs: DataFrame, keep: tuple = ()) -> DataFrame:
    """doc_id, stratum, the base counts, and more counts that rules use; ``keep`` are carried along."""
    text = F.coalesce(F.col("text"), F.lit(""))
    letters = F.translate(text, C.WORD_SPACE, "")

    def lines(t):
        real = F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, C.WORD_SPACE, "") != "")
        return C.let(real, lambda a: F.size(a) - F.size(F.array_distinct(a)))

    def word_counts(w):
        return F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"))

    counts = F.struct(F.length(letters).cast("long").alias("word_chars"),
                      (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                      (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"),
                      (F.length(text) - F.length(F.translate(text, "0123456789", ""))).cast("long").alias("n_digits"),
                      lines(text).cast("long").alias("n_dup_lines"),
                      (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long").alias("n_lines"),
                      C.let(C.words(text), word_counts).alias("w"))
    # a generator of one row: filters on the counts stay above it, so a text is measured once
    out = docs.select("doc_id", F.col("lang").alias("stratum"), *keep, F.explode(F.array(counts)).alias("m"))
    return (out.select("doc_id", "stratum", *keep, "m.*").select("*", "w.n_words", "w.n_repeat_words").drop("w").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def rule_bins() -> Column:
    """The rules of a document as array<struct<rule, bin>>, bins in thousandths of a share."""
    def share(part, whole):
        return F.when(F.col(whole) > 0, F.least(F.floor(1000 * F.col(part) / F.col(whole)), F.lit(1000))).otherwise(0).cast("int")

    rules = {"symbols": share("n_symbols", "word_chars"), "capitals": share("n_capitals", "word_chars"),
             "digits": share("n_digits", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
             "repeats": share("n_repeat_words", "n_words"),
             # mean word length, 25 code points and more being 1000
             "long_words": F.when(F.col("n_words") > 0, F.least(F.floor(40 * F.col("word_chars") / F.col("n_words")), F.lit(1000))).otherwise(0).cast("int")}
    return F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("bin")) for k, v in rules.items()])


N_RULES = 6


def binomial_below(n: Column, k: Column, p: float) -> Column:
    """Exact P(Binomial(n, p) <= k), summed from log probabilities; 1 once k reaches n."""
    odds = F.lit(p / (1 - p))
    zero = F.struct((n * F.log(F.lit(1 - p))).alias("lp"), F.exp(n * F.log(F.lit(1 - p))).alias("sum"))
    step = lambda a, j: C.let(a["lp"] + F.log((n - j + 1) / j * odds), lambda lp: F.struct(lp.alias("lp"), (a["sum"] + F.exp(lp)).alias("sum")))
    total = F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>")), zero, step, lambda a: a["sum"])
    return F.when(k >= n, F.lit(1.0)).otherwise(total)


def thresholds(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA, min_gain: float = MIN_GAIN) -> DataFrame:
    """``labelled``: stratum, bins (``rule_bins``), good (boolean). Returns stratum, rule, cutoff:
    a document of the stratum with bin >= cutoff is rejected. Rows only where a cutoff passes."""
    hist = C.written(labelled.filter(F.col("good").isNotNull()).select("stratum", "good", F.explode("bins").alias("b"))
                     .groupBy("stratum", "b.rule", "b.bin")
                     .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")), "rules-hist")
    group = W.partitionBy("stratum", "rule")
    upward = group.orderBy(F.col("bin").desc()).rowsBetween(W.unboundedPreceding, 0)
    strata = hist.groupBy("stratum").count().agg(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    level = F.lit(float(delta)) / (F.lit(N_RULES) * strata)
    tail = (hist.filter(F.col("bin") > 0)
            .withColumn("k", F.sum("good").over(upward)).withColumn("r", F.sum("bad").over(upward)))
    totals = hist.groupBy(F.col("stratum").alias("ts"), F.col("rule").alias("tr")).agg(F.sum("good").alias("n"), F.sum("bad").alias("m"))
    tested = tail.join(totals, F.col("stratum").eqNullSafe(F.col("ts")) & (F.col("rule") == F.col("tr")))
    # beyond n * alpha the bound cannot pass: no need to sum that far
    p_value = F.when(F.col("k") > F.col("n") * alpha, F.lit(1.0)).otherwise(binomial_below(F.col("n"), F.col("k"), alpha))
    tested = tested.withColumn("failed", (p_value > level).cast("int"))
    # fixed sequence: stops at the first cutoff that fails, coming from the loosest
    passed = tested.withColumn("stopped", F.max("failed").over(upward)).filter(F.col("stopped") == 0)
    gain = F.col("r") / F.greatest(F.col("m"), F.lit(1)) - F.col("k") / F.greatest(F.col("n"), F.lit(1))
    best = (passed.withColumn("gain", gain).filter(F.col("gain") >= min_gain)
            .withColumn("place", F.row_number().over(group.orderBy(F.col("gain").desc(), F.col("bin").desc()))))
    return best.filter("place = 1").select("stratum", "rule", F.col("bin").alias("cutoff"))


def learned_thresholds(measured: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Cutoffs from the documents (``measures``) that ``labels`` (doc_id, quality) marks; one row per
    stratum: rs (the stratum) and cutoffs, a map from rule to cutoff."""
    marks = labels.select(F.col("doc_id").alias("lid"), (F.col("quality") == 1).alias("good"))
    marked = measured.select("doc_id", "stratum", "base_failed", rule_bins().alias("bins")).join(marks, F.col("doc_id") == F.col("lid"))
    # what the base rules reject is rejected anyway: the cutoffs are chosen on the others
    cut = thresholds(marked.filter(~F.col("base_failed")).select("stratum", "bins", "good"), **how)
    per = cut.groupBy(F.col("stratum").alias("rs")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "cutoff")))).alias("cutoffs"))
    return C.written(per, "rules-cutoffs")


def verdicts(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with the boolean ``kept``."""
    joined = measured.join(cutoffs, F.col("stratum").eqNullSafe(F.col("rs")), "left")
    rejected = F.exists(rule_bins(), lambda b: F.coalesce(b["bin"] >= F.element_at(F.col("cutoffs"), b["rule"]), F.lit(False)))
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.when(F.col("cutoffs").isNull(), F.lit(False)).otherwise(rejected)).drop("rs", "cutoffs")


def judged(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Counts and verdict of every document."""
    measured = C.written(measures(docs), "rules-measures")
    return verdicts(measured, learned_thresholds(measured, labels, **how))


def kept_documents(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns. Texts are not shuffled: the cutoffs are a
    few rows, and a second pass over the documents applies them."""
    cutoffs = learned_thresholds(measures(docs), labels, **how)
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    passed = verdicts(measures(docs.select("doc_id", "text", "lang", row), keep=("_row",)), cutoffs).filter("kept")
    return passed.select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
