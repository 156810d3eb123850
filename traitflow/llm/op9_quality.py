"""Quality classifier: a generalised additive model with pairwise interactions.

The score of a text is ``sigmoid(intercept + sum_f table_f[bin_f] + sum_(f,g) table_fg[bin_f, bin_g])``.
Tables are learned by cyclic boosting: round after round, each feature in turn gets one shallow tree
(up to ``LEAVES`` leaves over its bins) fitted to the current gradient, shrunk and added to its table. When
a validation part stops improving, the pairs with the largest remaining gain are found on coarse
grids and boosted the same way with one cut on each axis. Every table can be read and plotted.

Scale: one vectorised pass computes the features of all documents (bounded memory: texts go in
blocks) and writes them; scoring is table look-ups on those rows. The model is fitted on at most
``MAX_LABELS`` labelled documents (smallest hashes of the id), the one bounded sample.

Inputs of a score come from the text alone. Edge cases: null and empty texts have all features 0 and get a
score; labels other than 0 and 1 are skipped; without labels of both kinds every score is the
labels' share (0.5 without any); repeated rows are scored alike; a null id is not held out or labelled;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C
from traitflow.llm import textnum as N

MAX_LABELS = 20_000
BLOCK = 4 << 20
BINS = 32
COARSE = 8
LEAVES = 4
RATE = 0.08
ROUNDS = 400
PATIENCE = 30
PAIRS = 10
SMOOTH = 5.0          # added to the second derivatives of a leaf

FEATURES = ("log_words", "word_length", "symbols", "capitals", "digits", "stops", "shouts", "bars", "non_ascii", "log_lines", "line_words",
            "repeats", "types", "top_word", "short_words", "long_words", "symbol_words", "length_spread")

_CLASS = {"symbols": b"#*$%&<>@^~_=+\\{}[]", "capitals": bytes(range(65, 91)), "digits": b"0123456789", "stops": b".,;:?", "shouts": b"!", "bars": b"|",
          "non_ascii": bytes(range(192, 256)), "lines": b"\n"}


def table_of(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(chars)] = 1
    return t


_TABLES = {k: table_of(v) for k, v in _CLASS.items()}


def features(texts: pa.Array):
    """Yields float32 arrays (rows, features), block by block."""
    for i, j in N.blocks(texts, BLOCK):
        raw, offsets = N.concatenated(texts.slice(i, j - i))
        n = j - i
        out = np.zeros((n, len(FEATURES)), np.float32)
        col = {f: k for k, f in enumerate(FEATURES)}
        size = np.maximum(np.diff(offsets), 1)

        def counted(name):
            total = np.r_[0, np.cumsum(_TABLES[name][raw], dtype=np.int64)]
            return total[offsets[1:]] - total[offsets[:-1]]  # noqa: B023

        for name in ("symbols", "capitals", "digits", "stops", "shouts", "bars", "non_ascii"):
            out[:, col[name]] = counted(name) / size
        lines = counted("lines")
        h, counts = N.word_hashes(raw, offsets)
        starts, lengths = N.word_spans(raw, offsets)
        words = np.maximum(counts, 1)
        out[:, col["log_words"]] = np.log1p(counts)
        out[:, col["log_lines"]] = np.log1p(lines)
        out[:, col["line_words"]] = counts / (lines + 1)
        doc = np.repeat(np.arange(n), counts)
        per = lambda x: np.bincount(doc, weights=x, minlength=n)  # noqa: B023, E731
        mean = per(lengths) / words
        out[:, col["word_length"]] = mean
        out[:, col["length_spread"]] = np.sqrt(np.maximum(per(lengths.astype(float) ** 2) / words - mean ** 2, 0))
        out[:, col["short_words"]] = per(lengths <= 3) / words
        out[:, col["long_words"]] = per(lengths >= 15) / words
        last = _TABLES["symbols"][raw[starts + lengths - 1]] if len(starts) else np.zeros(0)
        out[:, col["symbol_words"]] = per(last) / words
        grams = N.gram_hashes(h, 3)
        at = 0
        for k, c in enumerate(counts):
            if c:
                _, times = np.unique(h[at:at + c], return_counts=True)
                out[k, col["types"]] = len(times) / c ** 0.8     # distinct words, less dependent on length
                out[k, col["top_word"]] = times.max() / c
            if c >= 4:
                g = grams[at:at + c - 2]
                out[k, col["repeats"]] = 1 - len(np.unique(g)) / len(g)
            at += c
        yield out


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, rest (crc32 of the id modulo 3), x (features) of every row."""
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)).cast("int")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.concatenate(list(features(batch.column(2))))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "rest", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), rest.alias("rest"), "text").mapInArrow(run, "doc_id long, rest int, x array<float>")


class Model:
    """Tables over bins; ``fit`` in the driver on a bounded sample, ``scores`` inside tasks."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.main, self.pairs, self.cuts, self.coarse = [], [], [], []
        share = float(np.mean(y)) if len(y) else 0.5
        self.intercept = float(np.log(share / (1 - share))) if 0 < share < 1 else (0.0 if not len(y) else 8.0 * (1 if share else -1))
        if not len(y) or not 0 < share < 1:
            return
        for f in range(x.shape[1]):
            self.cuts.append(np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)))
            self.coarse.append(np.unique(np.quantile(x[:, f], np.arange(1, COARSE) / COARSE)))
        self.main = [np.zeros(len(c) + 1) for c in self.cuts]
        self.fit(x, y.astype(float))

    def binned(self, x):
        return ([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)],
                [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.coarse)])

    def fit(self, x, y):
        fine, coarse = self.binned(x)
        check = np.arange(len(y)) % 7 == 0      # rows come in hash order
        learn = ~check

        def boost(terms, tables, tree):
            best, best_at, saved = self.loss(fine, coarse, y, check), 0, [t.copy() for t in tables]
            logit = self.logit(fine, coarse)
            for k in range(ROUNDS):
                for t, keys in enumerate(terms):
                    p = 1 / (1 + np.exp(-logit))
                    size = tables[t].size
                    g = np.bincount(keys[learn], weights=(y - p)[learn], minlength=size)
                    h = np.bincount(keys[learn], weights=(p * (1 - p))[learn], minlength=size)
                    step = RATE * tree(g.reshape(tables[t].shape), h.reshape(tables[t].shape))
                    tables[t] += step
                    logit += step.reshape(-1)[keys]
                now = log_loss(logit[check], y[check])
                if now < best - 1e-6:
                    best, best_at, saved = now, k, [t.copy() for t in tables]
                elif k - best_at >= PATIENCE:
                    break
            for t, s in zip(tables, saved):
                t[...] = s

        boost(fine, self.main, stump_tree)
        found = []
        logit = self.logit(fine, coarse)
        p = 1 / (1 + np.exp(-logit))
        for a in range(x.shape[1]):
            for b in range(a + 1, x.shape[1]):
                shape = (len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)
                keys = coarse[a] * shape[1] + coarse[b]
                g = np.bincount(keys[learn], weights=(y - p)[learn], minlength=shape[0] * shape[1]).reshape(shape)
                h = np.bincount(keys[learn], weights=(p * (1 - p))[learn], minlength=shape[0] * shape[1]).reshape(shape)
                found.append((quadrants(g, h)[0], a, b, shape))
        found.sort(key=lambda r: -r[0])
        self.pairs = [(a, b, np.zeros(shape)) for _, a, b, shape in found[:PAIRS]]
        keys = [coarse[a] * t.shape[1] + coarse[b] for a, b, t in self.pairs]
        if keys:
            boost(keys, [t for _, _, t in self.pairs], lambda g, h: quadrants(g, h)[1])

    def logit(self, fine, coarse):
        out = np.full(len(fine[0]) if fine else 0, self.intercept)
        for f, t in enumerate(self.main):
            out += t[fine[f]]
        for a, b, t in self.pairs:
            out += t[coarse[a], coarse[b]]
        return out

    def loss(self, fine, coarse, y, where):
        return log_loss(self.logit(fine, coarse)[where], y[where])

    def scores(self, x):
        if not self.main:
            return np.full(len(x), 1 / (1 + np.exp(-self.intercept)))
        return 1 / (1 + np.exp(-self.logit(*self.binned(x))))


def log_loss(logit, y):
    return float(np.mean(np.logaddexp(0, logit) - y * logit)) if len(y) else 0.0


def stump_tree(g, h):
    """Newton values of a tree with up to LEAVES leaves over ordered bins, grown by the best cut."""
    leaves = [(0, len(g))]
    cg, ch = np.r_[0, np.cumsum(g)], np.r_[0, np.cumsum(h)]
    gain = lambda i, j: (cg[j] - cg[i]) ** 2 / (ch[j] - ch[i] + SMOOTH)
    while len(leaves) < LEAVES:
        best = (1e-9, None)
        for k, (i, j) in enumerate(leaves):
            if j - i > 1:
                cut = np.arange(i + 1, j)
                gains = gain(i, cut) + gain(cut, j) - gain(i, j)
                c = int(np.argmax(gains))
                if gains[c] > best[0]:
                    best = (gains[c], (k, i, int(cut[c]), j))
        if best[1] is None:
            break
        k, i, c, j = best[1]
        leaves[k:k + 1] = [(i, c), (c, j)]
    out = np.zeros(len(g))
    for i, j in leaves:
        out[i:j] = (cg[j] - cg[i]) / (ch[j] - ch[i] + SMOOTH)
    return out


def quadrants(g, h):
    """(gain, values) of the best tree with one cut on each axis of a grid."""
    cg = np.zeros((g.shape[0] + 1, g.shape[1] + 1))
    ch = cg.copy()
    cg[1:, 1:], ch[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    total = 0.0
    for part in (lambda c: c[i, j], lambda c: c[i, -1] - c[i, j], lambda c: c[-1, j] - c[i, j], lambda c: c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j]):
        total = total + part(cg) ** 2 / (part(ch) + SMOOTH)
    k = np.unravel_index(int(np.argmax(total)), total.shape)
    x, y = k[0] + 1, k[1] + 1
    out = np.zeros(g.shape)
    for rows in (slice(0, x), slice(x, None)):
        for cols in (slice(0, y), slice(y, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + SMOOTH)
    return float(total[k]), out


def fitted(rows: DataFrame, labels: DataFrame, learn: Column, max_labels: int = MAX_LABELS) -> Model:
    """A model from the rows (``measured``) that ``labels`` (doc_id, quality) marks and ``learn`` admits."""
    marks = labels.filter(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("id"), "quality")
    near = C.smallest_hashes(F.xxhash64("doc_id"), marks.count(), max_labels)
    sample = (rows.filter(learn & near).join(marks, F.col("doc_id") == F.col("id"))
              .select(F.xxhash64("doc_id").alias("h"), "x", "quality").orderBy("h", "quality", "x").limit(max_labels).collect())
    x = np.array([r["x"] for r in sample], np.float32).reshape(len(sample), len(FEATURES))
    return Model(x, np.array([r["quality"] for r in sample]))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, rest, score of rows of features."""
    def run(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.scores(x))], names=["doc_id", "rest", "score"])

    return rows.mapInArrow(run, "doc_id long, rest int, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.written(measured(C.table(spark, sf_dir, "documents")), "quality-features")
    model = fitted(rows, C.table(spark, sf_dir, "labels"), F.col("rest") != 1)
    out = scored(rows, model)
    return out.select("doc_id", F.coalesce(F.col("rest") == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
