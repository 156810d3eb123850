"""Benchmark decontamination by winnowing (JVM-side DataFrame code only).

A window is ``T`` (10) consecutive words of a benchmark item. Both sides are fingerprinted by
winnowing: of every ``T - K + 1`` (6) consecutive ``K``-gram hashes the smallest is kept (all of
equal ones), so any shared span of ``T`` words shares at least one kept fingerprint at the same
place. Fingerprints are joined, and each hit is extended by up to ``T - K`` words to both sides:
the document's windows around the hit are compared with the benchmark's windows by 64-bit hashes
of their words and counted only if the hash of a whole window agrees.

Shape of the plan. The document side is one narrow pass: a text becomes blocks of at most
``BLOCK`` window starts, a block its winnowed fingerprints, each with the hashes of the windows
that contain it. The benchmark side is as small as the benchmark; Spark picks a broadcast or a shuffle join from
its measured size. Only hits go on: windows that exist in the benchmark, as (doc, start). Items
enter by window class (equal windows share a class), so a phrase that many items hold is not
joined once per item and occurrence. Per document, starts become covered words by one sort.

Items of fewer than ``T`` words are one window of their own length; for each such length that the
benchmark has (at most nine) documents are searched by whole-window hashes.

Edge cases: null or empty text has no words and is not contaminated; an item without words has no
window and occurs nowhere; equal items each count; a null item id is skipped in the digest but
counts; repeated document rows are judged one by one; an empty benchmark leaves every document
clean; an empty documents table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C

T = 10            # words of a window (fixed by the contract)
K = 5             # words of a fingerprint
BLOCK = 256       # window starts of one block of a document
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"   # complement of the word rule (fixed by the contract)


def item_words(text: Column) -> Column:
    return F.filter(F.split(C.lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != F.lit(""))


def shifted(a: Column, b: Column, by: int, f) -> Column:
    """f(a[i], b[i + by]) for every i that both have."""
    n = F.size(b) - by
    return F.zip_with(F.slice(a, 1, n), F.slice(b, by + 1, n), f)


def grams(w: Column) -> Column:
    """Hashes of the K-grams of the array ``w`` (empty if it is shorter), from halves: 1 + 1, 2 + 2, 4 + 1."""
    of = lambda x, y: F.xxhash64(x, y)
    built = C.let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: C.let(shifted(h, h, 1, of), lambda two: C.let(
        shifted(two, two, 2, of), lambda four: shifted(four, h, 4, of))))
    return F.when(F.size(w) >= K, built).otherwise(F.array().cast("array<bigint>"))


def window_hashes(h: Column) -> Column:
    """Hashes of the T-word windows from the K-gram hashes ``h``: two halves each."""
    return F.when(F.size(h) > K, shifted(h, h, K, lambda x, y: F.xxhash64(x, y))).otherwise(F.array().cast("array<bigint>"))


def sliding(a: Column, f) -> Column:
    """f over every T - K + 1 (6) consecutive entries, by doubling (f is idempotent)."""
    return C.let(shifted(a, a, 1, f), lambda two: C.let(shifted(two, two, 2, f), lambda four: shifted(four, four, 2, f)))


def winnowed(h: Column) -> Column:
    """Places in ``h`` (hashes of K-grams) that are the smallest of some T - K + 1 consecutive ones; all of
    equal ones. A place is chosen if the largest of the minima of the spans around it is its own hash."""
    span = T - K + 1
    pad = F.array_repeat(F.lit(-(1 << 63)).cast("long"), span - 1)
    tops = C.let(F.concat(pad, sliding(h, lambda x, y: F.least(x, y)), pad), lambda m: sliding(m, lambda x, y: F.greatest(x, y)))
    chosen = C.let(tops, lambda t: F.filter(F.transform(h, lambda x, i: F.when(x == t[i], i).otherwise(F.lit(-1))), lambda i: i >= 0))
    return F.when(F.size(h) >= span, chosen).otherwise(F.array().cast("array<int>"))


def fingerprints(words: Column) -> Column:
    """array<struct<fp, at, near>> of an array of words: each kept K-gram hash, the first of the (at most
    six) windows that contain it, and the K-gram hashes that make up those windows."""
    def around(h):
        def one(p):
            low = F.greatest(p - (T - K), F.lit(0))
            high = F.least(p, F.size(h) - 1 - K) + K
            return F.struct(h[p].alias("fp"), low.cast("long").alias("at"), F.slice(h, low + 1, high - low + 1).alias("near"))
        return F.transform(winnowed(h), one)
    return C.let(grams(words), around)


def blocks(docs: DataFrame, key: str) -> DataFrame:
    """``key``, base, words: pieces of the word arrays with BLOCK window starts each, overlapping by
    T - 1 words, so every window lies in exactly one piece."""
    pieces = C.let(item_words(F.col("text")), lambda w: F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(w) - T, F.lit(0))) / BLOCK).cast("int")),
        lambda b: F.struct((b * BLOCK).cast("long").alias("base"), F.slice(w, b * BLOCK + 1, BLOCK + T - 1).alias("words"))))
    return docs.select(key, F.explode(pieces).alias("b")).select(key, "b.base", "b.words")


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Occurrences of benchmark windows: row (key of the document row), at (first word), n (words), win
    (hash of the window), distinct."""
    source = items.select("item_id", item_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    long = source.filter(F.size("w") >= T)
    test = long.select(F.explode(fingerprints(F.col("w"))).alias("f")).select(F.col("f.fp").alias("tfp"), F.explode(window_hashes(F.col("f.near"))).alias("twin"))
    # one row per fingerprint: the windows around it in any item
    test = C.written(test.groupBy("tfp").agg(F.collect_set("twin").alias("twins")), "decon-test")
    doc = (blocks(docs, "row").select("row", "base", F.explode(fingerprints(F.col("words"))).alias("f"))
           .select("row", "base", "f.fp", "f.at", "f.near"))
    met = doc.join(test, F.col("fp") == F.col("tfp"))
    found = met.select("row", F.explode(F.filter(F.transform(window_hashes(F.col("near")), lambda g, i: F.struct(
        (F.col("base") + F.col("at") + i).alias("at"), g.alias("win"))), lambda s: F.array_contains(F.col("twins"), s["win"]))).alias("s"))
    out = found.select("row", "s.at", F.lit(T).alias("n"), "s.win")
    short = C.written(source.filter(F.size("w") < T).select(F.size("w").alias("n"), F.xxhash64(F.col("w")).alias("win")).distinct(), "decon-short")
    for row in short.select("n").distinct().collect():  # lengths 1 to T - 1 at most
        n = row["n"]
        spans = (docs.select("row", F.explode(C.let(item_words(F.col("text")), lambda w: F.transform(
            F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>")),  # noqa: B023
            lambda i: F.struct(i.cast("long").alias("at"), F.xxhash64(F.slice(w, i + 1, n)).alias("win"))))).alias("s"))  # noqa: B023
            .select("row", "s.at", "s.win"))
        wanted = short.filter(F.col("n") == n).select(F.col("win").alias("w"), "n")
        out = out.unionByName(spans.join(wanted, F.col("win") == F.col("w")).select("row", "at", F.col("n").cast("int").alias("n"), "win"))
    return out.distinct()


def item_windows(items: DataFrame) -> DataFrame:
    """item (number of the item row), item_id, n, win: the distinct windows of each item."""
    w = items.withColumn("item", F.monotonically_increasing_id()).select("item", "item_id", item_words(F.col("text")).alias("w"))
    wins = F.when(F.size("w") >= T, C.let(grams(F.col("w")), lambda h: F.transform(window_hashes(h), lambda g: F.struct(F.lit(T).alias("n"), g.alias("win")))))
    whole = F.array(F.struct(F.size("w").alias("n"), F.xxhash64(F.col("w")).alias("win")))
    return w.filter(F.size("w") > 0).select("item", "item_id", F.explode(F.array_distinct(F.coalesce(wins, whole))).alias("s")).select("item", "item_id", "s.n", "s.win")


def covered_words(spans: Column) -> Column:
    """Number of words in the union of array<struct<at, n>>."""
    def total(s):
        return F.aggregate(s, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("end")), lambda a, x: F.struct(
            (a["sum"] + F.greatest(x["at"] + x["n"] - F.greatest(a["end"], x["at"]), F.lit(0))).alias("sum"),
            F.greatest(a["end"], x["at"] + x["n"]).alias("end")), lambda a: a["sum"])
    return C.let(F.sort_array(spans), total)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and spans (array<struct<at, n>>, the
    hit windows) for every document row."""
    docs = docs.select(F.col("doc_id"), F.col("text"))
    keyed = docs.withColumn("row", C.row_key())
    found = C.written(hits(keyed, items), "decon-hits")
    spans = found.groupBy("row").agg(F.collect_set(F.struct(F.col("at"), F.col("n").cast("long").alias("n"))).alias("spans"))
    # items by window class: windows of a document, then the items that hold them
    owners = C.written(item_windows(items), "decon-items")
    pairs = (found.select("row", "n", "win").distinct()
             .join(owners.groupBy(F.col("n").alias("on"), F.col("win").alias("ow")).agg(F.collect_list(F.struct("item", "item_id")).alias("own")),
                   (F.col("n") == F.col("on")) & (F.col("win") == F.col("ow")))
             .groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("own"))).alias("own")))
    listed = F.array_join(F.array_sort(F.transform("own", lambda o: o["item_id"].cast("string"))), ",")
    hit = (spans.join(pairs, "row").select(
        F.col("row").alias("hrow"), covered_words(F.col("spans")).alias("n_hit"), F.size("own").cast("long").alias("n_items"), listed.alias("items"),
        F.transform("spans", lambda s: s).alias("spans")))
    counted = docs.select("doc_id", F.size(item_words(F.col("text"))).cast("long").alias("n_words"), C.row_key().alias("row"))
    out = counted.join(hit, F.col("row") == F.col("hrow"), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("spans", F.array().cast("array<struct<at:bigint,n:bigint>>")).alias("spans"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with their columns."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    keyed = docs.select(row, C.row_key().alias("_key"))
    hit = hits(docs.select(C.row_key().alias("row"), "text"), items).select(F.col("row").alias("_hit")).distinct()
    return keyed.join(C.written(hit, "decon-hit"), F.col("_key").eqNullSafe(F.col("_hit")), "left_anti").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark")).drop("spans")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""
