"""Exact substring dedup: every byte covered by a 100-byte string that also starts earlier is removed.

Depth-limited radix sort of the suffixes: suffixes are told apart only through their first ``T``
(100) bytes, by most-significant-digit passes over Spark shuffles. A suffix that is alone in its
group after a pass cannot repeat and leaves; what is still equal at depth T is a repeated window, and
all members but the earliest are removed.

* A digit that all equal windows share wherever they stand is the smallest ``K``-byte gram hash inside
  the window (the leftmost of equal ones). Consecutive suffixes with the same smallest gram form a
  run of up to ``T - K + 1`` suffixes, so one row (gram, digest of the whole run, place) stands for
  about 31 suffixes.
* Pass 1 sorts runs by (gram, digest, document, start). A run equal to an earlier one is removed
  whole. A gram met once, or only in equal runs, is settled. Only runs whose gram occurs with other
  surroundings go on (edges of repeated passages, some 5 % of the runs).
* Pass 2 fetches the bytes of those runs, groups them by gram and sorts their suffixes by the
  hash of all T bytes, inside tasks; a gram with more than ``HOT`` runs is sorted by window in Spark
  instead, so no group needs one task.

Equal runs inside a block of a task collapse before the first shuffle, so a string that fills many
documents (or one document) sends one row a block. Strings are compared by 64-bit hashes of whole
windows within equal 64-bit gram hashes. Removed bytes are judged on the input, not on what is left.

Edge cases: null text is empty; texts under T bytes lose nothing; a very long text is cut into
overlapping pieces without changing results; a null id sorts first; rows that share an id are ordered by
their texts, rows equal in both are one document whose result each of them gets; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C
from traitflow.llm import textnum as N

T = 100
K = 32
BLOCK = 1 << 20
HOT = 4_000
_LOW = np.uint64((1 << 21) - 1)      # places inside a block, which has under 2 ** 21 bytes


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the K bytes from each position (K a power of two)."""
    h, size, level = N.BYTE[raw], 1, 0
    while size < K:
        h = h[:-size] * np.uint64(N.STEPS[level]) + h[size:]
        size, level = size * 2, level + 1
    return N.mix(h)


def window_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def runs(raw: np.ndarray, offsets: np.ndarray):
    """(row, start in row, suffixes, gram, digest) of each run of suffixes with the same smallest gram."""
    if len(raw) < T:
        return None
    gram = rolling(raw)
    place = (window_min(gram & ~_LOW | np.arange(len(gram), dtype=np.uint64), T - K + 1) & _LOW).astype(np.int64)
    at = np.arange(len(place))
    row = np.searchsorted(offsets, at, side="right") - 1
    fits = at + T <= offsets[row + 1]
    at, row, place = at[fits], row[fits], place[fits]
    if not len(at):
        return None
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    s, e = at[first], at[last]
    fwd, inv = N.powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(N.BYTE[raw] * fwd[:len(raw)], out=total[1:])
    digest = N.mix((total[e + T] - total[s]) * inv[s] ^ ((e - s).astype(np.uint64) << np.uint64(56)))
    return row[first], s - offsets[row[first]], e - s + 1, gram[place[first]], digest


def merged(doc: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Union of the byte intervals [a, b) of each document."""
    if not len(doc):
        return doc, a, b
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    new_doc = np.r_[True, doc[1:] != doc[:-1]]
    # running end within a document: shift each document beyond the one before it
    shift = (np.cumsum(new_doc) - 1) * (int(b.max()) + 2)
    reach = np.maximum.accumulate(b + shift)
    new = np.r_[True, (a + shift)[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a)) - 1
    return doc[first], a[first], (reach - shift)[last]


def pieces(ids: np.ndarray, texts: pa.Array):
    """(ids, base of each row, bytes, offsets): blocks of rows; longer texts in overlapping pieces."""
    for i, j in N.blocks(texts, BLOCK):
        raw, offsets = N.concatenated(texts.slice(i, j - i))
        if len(raw) <= BLOCK:
            yield ids[i:j], np.zeros(j - i, np.int64), raw, offsets
        else:   # one long text
            for base in range(0, len(raw), BLOCK):
                part = raw[base:base + BLOCK + T - 1]
                yield ids[i:j], np.array([base]), part, np.array([0, len(part)])


def place_of(a, length):
    return (a.astype(np.int64) << 32) | length.astype(np.int64)


def map_runs(batches):
    """Rows (gram, digest, doc, place): runs, first of its equals in the block; and, with a negative
    place, byte intervals already known to repeat."""
    def out(g, d, doc, place):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (g.view(np.int64), d.view(np.int64), doc, place)], names=["gram", "digest", "doc", "place"])

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for part, base, raw, offsets in pieces(ids, batch.column(1)):
            found = runs(raw, offsets)
            if found is None:
                continue
            row, s, n, g, d = found
            doc, s = part[row], s + base[row]
            order = np.lexsort((s, doc, d, g))
            doc, s, n, g, d = doc[order], s[order], n[order], g[order], d[order]
            again = np.r_[False, (g[1:] == g[:-1]) & (d[1:] == d[:-1])]
            yield out(g[~again], d[~again], doc[~again], place_of(s[~again], n[~again]))
            if again.any():
                md, ma, mb = merged(doc[again], s[again], s[again] + n[again] + (T - 1))
                yield out(N.mix(md.astype(np.uint64)), np.zeros(len(md), np.uint64), md, -place_of(ma, mb - ma) - 1)


def reduce_runs(batches):
    """Input sorted by (gram, digest, doc, place). Rows (gram, doc, place, state): state 0 a repeated
    interval (place holds its length), 1 a run to look at closer (place holds its suffixes)."""
    prev, pending = None, None      # last (gram, digest); the first run of its gram while alone in it

    def out(g, doc, place, state):
        return pa.RecordBatch.from_arrays([pa.array(g), pa.array(doc), pa.array(place), pa.array(np.full(len(g), state, np.int32))], names=["gram", "doc", "place", "state"])

    for batch in batches:
        g, d, doc, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        known = place < 0
        if known.any():
            yield out(g[known], doc[known], -place[known] - 1, 0)
            g, d, doc, place = g[~known], d[~known], doc[~known], place[~known]
        if not len(g):
            continue
        pg, pd = prev if prev is not None else (~g[0], d[0])
        before_g, before_d = np.r_[pg, g[:-1]], np.r_[pd, d[:-1]]
        new_g = g != before_g
        new_d = new_g | (d != before_d)
        again = ~new_d
        if again.any():
            yield out(g[again], doc[again], place_of(place[again] >> 32, (place[again] & 0xFFFFFFFF) + (T - 1)), 0)
        other = new_d & ~new_g      # another surrounding of a known gram
        heads = np.flatnonzero(new_g)
        mixed = np.zeros(len(heads), bool)
        if other.any():
            k = np.searchsorted(heads, np.flatnonzero(other), side="right") - 1
            mixed[k[k >= 0]] = True
            if (k < 0).any() and pending is not None:
                yield out(*(np.array([x]) for x in pending), 1)
                pending = None
        if len(heads):
            pending = None if mixed[-1] else (g[heads[-1]], doc[heads[-1]], place[heads[-1]])
        take = other
        take[heads[mixed]] = True
        if take.any():
            yield out(g[take], doc[take], place[take], 1)
        prev = (g[-1], d[-1])


def map_contexts(batches):
    """Rows (doc, text, runs) to one row a run: gram, doc, start, its bytes."""
    for batch in batches:
        docs, texts, runs_ = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string()), batch.column(2).to_pylist()
        gs, ds, ss, cs = [], [], [], []
        for doc, text, found in zip(docs, texts, runs_):
            raw = memoryview(text.as_buffer())
            for r in found:
                s, n = r["place"] >> 32, r["place"] & 0xFFFFFFFF
                gs.append(r["gram"])
                ds.append(doc)
                ss.append(s)
                cs.append(raw[s:s + n + T - 1].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(gs, pa.int64()), pa.array(ds, pa.int64()), pa.array(ss, pa.int64()), pa.array(cs, pa.binary())], names=["gram", "doc", "start", "bytes"])


def window_hashes(contexts: pa.Array):
    """(row, place in row, hash) of each T-byte window of binary rows."""
    raw, offsets = N.concatenated(contexts.cast(pa.large_binary()).view(pa.large_string()))
    fwd, inv = N.powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(N.BYTE[raw] * fwd[:len(raw)], out=total[1:])
    n = np.diff(offsets) - T + 1
    row = np.repeat(np.arange(len(n)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[row] + inside
    return row, inside, N.mix((total[at + T] - total[at]) * inv[at])


def resolve(batches):
    """Input sorted by gram. Repeated windows among the runs of each gram, as intervals (doc, a, b)."""
    held: list[pa.Table] = []
    size = 0

    def settle(table: pa.Table):
        ctx = table.column(3).combine_chunks()
        row, inside, h = window_hashes(ctx)
        doc = table.column(1).to_numpy()[row]
        at = table.column(2).to_numpy()[row] + inside
        order = np.lexsort((at, doc, h))
        again = order[1:][h[order][1:] == h[order][:-1]]
        md, a, b = merged(doc[again], at[again], at[again] + T)
        return pa.RecordBatch.from_arrays([pa.array(md), pa.array(a), pa.array(b)], names=["doc", "a", "b"])

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += batch.nbytes
        if size >= 4 * BLOCK:
            whole = pa.concat_tables(held)
            g = whole.column(0).to_numpy()
            cut = int(np.searchsorted(-(g != g[-1]).astype(np.int8), 0, side="left"))   # the last gram may go on
            if cut:
                yield settle(whole.slice(0, cut))
                whole = whole.slice(cut)
            held, size = [whole], whole.nbytes
    if held and sum(t.num_rows for t in held):
        yield settle(pa.concat_tables(held))


def with_runs(docs: DataFrame, open_runs: DataFrame) -> DataFrame:
    """doc, text, runs of the documents that have rows in ``open_runs``."""
    wanted = open_runs.groupBy(F.col("doc").alias("d")).agg(F.collect_list(F.struct("gram", "place")).alias("runs"))
    return docs.join(wanted, F.col("doc") == F.col("d")).select("doc", "text", "runs")


def resolve_hot(rows: DataFrame) -> DataFrame:
    """As ``resolve``, by a shuffle of windows. ``rows``: as ``with_runs`` returns."""
    def windows_of(batches):
        for batch in map_contexts(batches):
            row, inside, h = window_hashes(batch.column(3))
            doc, start = batch.column(1).to_numpy()[row], batch.column(2).to_numpy()[row] + inside
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc), pa.array(start)], names=["h", "doc", "a"])

    windows = rows.mapInArrow(windows_of, "h long, doc long, a long")
    first = windows.groupBy(F.col("h").alias("fh")).agg(F.min(F.struct("doc", "a")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return windows.join(first, (F.col("h") == F.col("fh")) & (F.struct("doc", "a") != F.col("first"))).select("doc", "a", (F.col("a") + T).alias("b"))


def repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc, spans (array<struct<a, b>>, byte intervals to remove, not merged). ``docs``: doc (unique), text."""
    mapped = docs.mapInArrow(map_runs, "gram long, digest long, doc long, place long")
    sorted_runs = mapped.repartition("gram").sortWithinPartitions("gram", "digest", "doc", "place")
    first = C.written(sorted_runs.mapInArrow(reduce_runs, "gram long, doc long, place long, state int"), "sub-runs")
    open_runs = first.filter("state = 1")
    large = C.written(open_runs.groupBy("gram").count().filter(F.col("count") > hot).select(F.col("gram").alias("g")), "sub-hot")
    known = first.filter("state = 0").select("doc", F.shiftright("place", 32).alias("a"), (F.shiftright("place", 32) + F.col("place").bitwiseAND(0xFFFFFFFF)).alias("b"))
    any_hot = not large.isEmpty()
    usual = open_runs.join(large, F.col("gram") == F.col("g"), "left_anti") if any_hot else open_runs
    contexts = with_runs(docs, usual).mapInArrow(map_contexts, "gram long, doc long, start long, bytes binary")
    found = contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(resolve, "doc long, a long, b long")
    if any_hot:
        found = found.unionByName(resolve_hot(with_runs(docs, open_runs.join(large, F.col("gram") == F.col("g"), "left_semi"))))
    return known.unionByName(found).groupBy(F.col("doc").alias("d")).agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def cut(batches):
    for batch in batches:
        docs, texts, spans = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string()), batch.column(2).to_pylist()
        rows = []
        for doc, text, found in zip(docs, texts, spans):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            gone, n, at, kept = 0, 0, 0, []
            end = -1
            for x in sorted((x["a"], x["b"]) for x in found or ()):
                if x[0] > end:
                    n += 1
                    kept.append(raw[at:x[0]])
                    gone += x[1] - x[0]
                elif x[1] > end:
                    gone += x[1] - end
                end = max(end, x[1])
                at = end
            kept.append(raw[at:])
            rest = b"".join(kept)
            rows.append((doc, len(raw), gone, n, hashlib.sha256(rest).hexdigest(), rest))
        cols = list(zip(*rows)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                                         names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


SCHEMA = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def deduplicated(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) for each row of ``docs``.

    The documents are exchanged by id once; the fetch of run bytes and the final cut read the same
    exchange."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = docs.groupBy("doc_id").count().filter((F.col("count") > 1) | F.col("doc_id").isNull())
    if odd.isEmpty():
        own = docs.withColumnRenamed("doc_id", "doc").filter("doc is not null")
        spans = repeats(own, hot)
        return own.join(spans, F.col("doc") == F.col("d"), "left").select("doc", "text", "spans").mapInArrow(cut, SCHEMA).withColumnRenamed("doc", "doc_id")
    # ids that are null or repeat: number the distinct (id, text) in their order
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), digest.alias("h")).groupBy("doc_id", "h").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("times"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")
    own = C.written(ordered.withColumn("doc", F.monotonically_increasing_id()), "sub-rows")
    texts = own.select("doc", "text")
    out = texts.join(repeats(texts, hot), F.col("doc") == F.col("d"), "left").select("doc", "text", "spans").mapInArrow(cut, SCHEMA)
    ids = own.select(F.col("doc").alias("o"), "doc_id", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("k"))
    return out.join(ids, F.col("doc") == F.col("o")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(C.table(spark, sf_dir, "documents")).drop("kept")


# Windows as hex strings: 100 bytes are 200 digits.
ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, i, hash(substr(x, 2 * i + 1, 200)) AS h FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 99)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM p) WHERE k > 1),
s AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS fresh FROM r),
t AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM s),
u AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b FROM t GROUP BY ALL),
v AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM u),
w AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(b) AS last,
             string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM v JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN x ELSE kept || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN w USING (doc_id)
"""
