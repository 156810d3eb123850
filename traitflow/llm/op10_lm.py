"""Language-model scoring by deleted interpolation of n-gram maximum-likelihood estimates.

Model: ``p(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1)``, where b is the bucket (power of
two) of the context's frequency c(v). The mixture weights come from expectation-maximisation on
held-out counts: a fixed tenth of the training documents is predicted from the counts of all others,
each document's own counts being deleted from c(v w), c(v), c(w) and N.

Counts cover all training documents and are exact up to 64-bit (words) and 52-bit (pairs) hashes.
Nothing that grows with the corpus is broadcast or collected:

1. Documents are packed into blocks of about ``BLOCK`` bytes and written (compressed), so that later passes
   see the same blocks whatever tasks are repeated.
2. Each block sends its sorted distinct n-gram hashes with local counts, delta-coded, cut into ranges
   of the hash. A task adds up one range at a time and answers every block with the total
   counts in the block's own order, without the hashes.
3. Weights: the blocks of the held-out tenth are scored into a histogram of (bucket, p2, p1), a table of fixed
   size on which EM runs in the driver.
4. All blocks are joined with their totals and scored.

Edge cases: null and empty texts have one token, the end; a null id counts as the text '' in the
split; without training tokens every probability is 1 / (V + 1) = 1 and scores are 0; repeated rows are
separate documents; a very long text is one block; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C
from traitflow.llm import textnum as N

BLOCK = 3 << 20                  # bytes of text of a block
RANGE = 2_000_000                # n-gram entries that one step of the summing task holds
END = np.uint64(0x452821E638D01377)   # hash of the end token
PAIR_SHIFT = np.uint64(12)       # pairs keep 52 bits
BUCKETS = 40
GRID = 2                         # histogram steps per power of two of a probability
CELLS = 60 * GRID
ROUNDS = 200
HELD = 10                        # scored only: crc32 of the id modulo HELD is 0; weights: 1


def planes(x: np.ndarray) -> bytes:
    """Bytes of an integer array, all lowest bytes first: the zero planes of small numbers compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def unplanes(raw: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).reshape(-1)


def zip_bytes(raw: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(raw)


def unzip_bytes(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def make_blocks(docs: DataFrame) -> DataFrame:
    """block, tune (holds documents of the weight split only), tokens, ids, parts (split of each), ends
    (byte offset after each document), text (compressed)."""
    split = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(HELD)).cast("int")

    def pack(batches):
        held = {True: [], False: []}
        size = {True: 0, False: 0}
        seq = 0

        def flush(tune):
            nonlocal seq
            table = pa.concat_tables(held[tune]).combine_chunks()
            texts = table.column(2).cast(pa.large_string())
            texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
            raw, offsets = N.concatenated(texts)
            _, counts = N.word_hashes(raw, offsets)
            number = (TaskContext.get().partitionId() << 32) + seq
            seq += 1
            held[tune], size[tune] = [], 0
            one = lambda a, t: pa.array([a], t)
            return pa.RecordBatch.from_arrays(
                [one(number, pa.int64()), one(tune, pa.bool_()), one(int(counts.sum()) + len(counts), pa.int64()), one(table.column(0).to_pylist(), pa.list_(pa.int64())),
                 one(table.column(1).to_pylist(), pa.list_(pa.int32())), one(offsets[1:].tolist(), pa.list_(pa.int64())), one(zip_bytes(raw.tobytes(), 3), pa.binary())],
                names=["block", "tune", "tokens", "ids", "parts", "ends", "text"])

        for batch in batches:
            table = pa.Table.from_batches([batch]).set_column(2, "text", batch.column(2).cast(pa.large_string()))
            mask = pa.array(batch.column(1).to_numpy() == 1)
            for tune, part in ((True, table.filter(mask)), (False, table.filter(pa.compute.invert(mask)))):
                column = part.column(2).combine_chunks()
                column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
                for i, j in N.blocks(column, BLOCK) if part.num_rows else ():
                    piece = part.slice(i, j - i)
                    held[tune].append(piece)
                    size[tune] += pa.compute.sum(pa.compute.binary_length(piece.column(2))).as_py() or 0
                    if size[tune] >= BLOCK // 2:
                        yield flush(tune)
        for tune in held:
            if held[tune]:
                yield flush(tune)

    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), split.alias("part"), "text").mapInArrow(
        pack, "block long, tune boolean, tokens long, ids array<bigint>, parts array<int>, ends array<bigint>, text binary")
    return C.written(packed, "lm-blocks")


class Block:
    """Tokens of a block: tok and pair are places in the sorted distinct hashes (words, pairs)."""

    def __init__(self, text: bytes, ends, parts):
        raw = np.frombuffer(unzip_bytes(text), np.uint8)
        h, counts = N.word_hashes(raw, np.r_[0, np.asarray(ends, np.int64)])
        self.lengths = counts + 1
        self.doc = np.repeat(np.arange(len(counts), dtype=np.int32), self.lengths)
        tokens = np.full(int(self.lengths.sum()), END, np.uint64)
        tokens[np.arange(len(h)) + np.repeat(np.arange(len(counts)), counts)] = h
        del raw, h
        # the end before it stands for the beginning of a document
        pairs = N.mix(np.r_[END, tokens[:-1]] * np.uint64(N.STEPS[3]) + tokens) >> PAIR_SHIFT
        self.words, tok = np.unique(tokens, return_inverse=True)
        self.tok = tok.astype(np.int32)
        del tokens, tok
        self.pairs, pair = np.unique(pairs, return_inverse=True)
        self.pair = pair.astype(np.int32)
        self.prev = np.r_[self.tok[-1], self.tok[:-1]]    # the last token is an end
        self.parts = np.asarray(parts, np.int32)


def totals(blocks: DataFrame) -> DataFrame:
    """block, kind (1 words, 2 pairs), place (of the hash range), counts (all training occurrences, in the order of
    the block's distinct hashes), seen (distinct with a count), tokens (sum), as a written table."""
    spark = blocks.sparkSession
    ranges = max(1, math.ceil(2 * (blocks.agg(F.sum("tokens")).first()[0] or 0) / RANGE))

    def send(batches):
        for batch in batches:
            for row in single_rows(batch):
                b = Block(row["text"], row["ends"], row["parts"])
                train = (b.parts != 0)[b.doc]
                for kind, keys, at, bits in ((1, b.words, b.tok, 64), (2, b.pairs, b.pair, 52)):
                    local = np.bincount(at, weights=train, minlength=len(keys)).astype(np.uint32)
                    edges = np.searchsorted(keys, np.array([(k << bits) // ranges for k in range(1, ranges)], dtype=np.uint64))
                    out = []
                    for k, (i, j) in enumerate(zip(np.r_[0, edges], np.r_[edges, len(keys)])):
                        if i < j:
                            deltas = np.diff(keys[i:j], prepend=np.uint64(0))
                            out.append((row["block"], kind, k, int(j - i), zip_bytes(planes(deltas) + planes(local[i:j]))))
                    yield records(out, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()), ("block", "kind", "place", "n", "data"))

    def add(batches):
        held, key = [], None
        for batch in batches:
            for row in single_rows(batch):
                if (row["kind"], row["place"]) != key and held:
                    yield summed(held, key)
                    held = []
                key = (row["kind"], row["place"])
                held.append(row)
        if held:
            yield summed(held, key)

    def summed(rows, key):
        keys, local = [], []
        for r in rows:
            raw, n = unzip_bytes(r["data"]), r["n"]
            keys.append(np.cumsum(unplanes(raw[:8 * n], np.uint64, n), dtype=np.uint64))
            local.append(unplanes(raw[8 * n:], np.uint32, n))
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(local), minlength=len(distinct)).astype(np.uint64)
        out, start = [], 0
        for i, r in enumerate(rows):
            mine = total[at[start:start + r["n"]]]
            start += r["n"]
            out.append((r["block"], key[0], key[1], r["n"], zip_bytes(planes(mine)), int((total > 0).sum()) if i == 0 else 0, int(total.sum()) if i == 0 else 0))
        return records(out, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()), ("block", "kind", "place", "n", "counts", "seen", "tokens"))

    sent = blocks.select("block", "ends", "parts", "text").mapInArrow(send, "block long, kind int, place int, n int, data binary")
    together = sent.repartition(min(2 * ranges, max(64, 4 * spark.sparkContext.defaultParallelism, ranges // 8)), "kind", "place").sortWithinPartitions("kind", "place")
    return C.written(together.mapInArrow(add, "block long, kind int, place int, n int, counts binary, seen long, tokens long"), "lm-totals")


def single_rows(batch: pa.RecordBatch):
    """Rows as dicts, one at a time: blocks are large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def records(rows, kinds, names):
    cols = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=list(names))


def joined(blocks: DataFrame, sums: DataFrame) -> DataFrame:
    mine = sums.groupBy(F.col("block").alias("of")).agg(F.sort_array(F.collect_list(F.struct("kind", "place", "n", "counts"))).alias("sums"))
    return blocks.join(mine, F.col("block") == F.col("of")).select("ids", "parts", "ends", "text", "sums")


def looked_up(row):
    """A Block and the total counts of its words and pairs."""
    b = Block(row["text"], row["ends"], row["parts"])
    counts = {k: np.concatenate([unplanes(unzip_bytes(s["counts"]), np.uint64, s["n"]) for s in row["sums"] if s["kind"] == k]).astype(np.int64) for k in (1, 2)}
    return b, counts[1], counts[2]


def bucket(c: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.ceil(np.log2(1.0 + c))).astype(np.int64)


def weights(blocks: DataFrame, sums: DataFrame, n: int, v: int) -> np.ndarray:
    """Mixture weights (bucket, order): rows (l0, l1, l2) that sum to 1."""
    def histogram(batches):
        def level(p):    # 0 for p = 0, else 1 + steps below 1
            with np.errstate(divide="ignore"):
                return np.where(p > 0, np.minimum(CELLS - 2, np.round(-GRID * np.log2(np.maximum(p, 1e-300)))) + 1, 0).astype(np.int64)

        def own(doc, at, size):
            _, back, times = np.unique(doc.astype(np.int64) * size + at, return_inverse=True, return_counts=True)
            return times[back]

        for batch in batches:
            for row in single_rows(batch):
                b, one, two = looked_up(row)
                # contexts of a document: its own tokens but for the beginning, which is one more end
                c2 = two[b.pair] - own(b.doc, b.pair, len(two))
                cv = np.maximum(one[b.prev] - own(b.doc, b.prev, len(one)), c2)
                c1 = one[b.tok] - own(b.doc, b.tok, len(one))
                rest = np.maximum(n - b.lengths[b.doc], 1)
                cell = (bucket(cv) * CELLS + level(c2 / np.maximum(cv, 1))) * CELLS + level(c1 / rest)
                cells, times = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(times)], names=["cell", "times"])

    cells = joined(blocks.filter("tune"), sums).mapInArrow(histogram, "cell long, times long").groupBy("cell").agg(F.sum("times").alias("times")).collect()
    cell = np.array([r["cell"] for r in cells], np.int64)
    times = np.array([r["times"] for r in cells], float)
    prob = lambda k: np.where(k > 0, 2.0 ** (-(k - 1) / GRID), 0.0)
    at, p2, p1 = cell // CELLS // CELLS, prob(cell // CELLS % CELLS), prob(cell % CELLS)
    p = np.stack([np.full(len(cell), 1.0 / (v + 1)), p1, p2], axis=1)

    def em(where):
        lam = np.array([0.1, 0.3, 0.6])
        for _ in range(ROUNDS):
            part = p[where] * lam
            part /= part.sum(axis=1, keepdims=True)
            lam = (part * times[where, None]).sum(axis=0) / times[where].sum()
        lam = np.maximum(lam, 1e-9)     # nothing gets probability 0
        return lam / lam.sum()

    common = em(np.ones(len(cell), bool)) if len(cell) else np.array([0.1, 0.3, 0.6])
    lam = np.array([em(at == k) if times[at == k].sum() >= 100 else common for k in range(BUCKETS)])
    lam[0] = [lam[0, 0], lam[0, 1] + lam[0, 2], 0.0]    # a context never seen predicts nothing
    if n == 0:
        lam[:] = [1.0, 0.0, 0.0]
    return lam


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    blocks = make_blocks(docs)
    sums = totals(blocks)
    row = sums.filter("kind = 1").agg(F.sum("tokens"), F.sum("seen")).first()
    n, v = int(row[0] or 0), int(row[1] or 0)
    lam = weights(blocks, sums, n, v)

    def score(batches):
        for batch in batches:
            for row in single_rows(batch):
                b, one, two = looked_up(row)
                c1, c2, cv = one[b.tok], two[b.pair], one[b.prev]
                starts = np.r_[0, np.cumsum(b.lengths)[:-1]]
                base = np.log10((c1 + 0.1) / (n + 0.1 * (v + 1)))
                k = bucket(cv)
                p = lam[k, 0] / (v + 1) + lam[k, 1] * c1 / max(n, 1) + lam[k, 2] * c2 / np.maximum(cv, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(b.parts == 0), pa.array(b.lengths), pa.array(np.add.reduceat((c1 > 0).astype(np.int64), starts)),
                     pa.array(np.full(len(starts), n)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(p), starts))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return joined(blocks, sums).mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(C.table(spark, sf_dir, "documents"))
