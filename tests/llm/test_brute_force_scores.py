"""Scores and verdicts of trained operators against plain computations with the fitted parameters."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from traitflow.llm import common as C
from traitflow.llm import op6_rules, op9_quality, op10_lm

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


# -- op10

def test_mixture_scores(docs, rows):
    """Every score is the mixture of plain counts under the learned weights."""
    blocks = op10_lm.make_blocks(docs)
    sums = op10_lm.totals(blocks)
    row = sums.filter("kind = 1").agg(F.sum("tokens"), F.sum("seen")).first()
    n, v = int(row[0]), int(row[1])
    lam = op10_lm.weights(blocks, sums, n, v)
    assert np.allclose(lam.sum(axis=1), 1) and (lam >= 0).all()

    tokens = lambda t: re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)) + [None]
    words, pairs, v2 = Counter(), Counter(), set()
    for d, t, *_ in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 10 != 0:      # nothing is learned from null ids
            seq = tokens(t)
            words.update(seq)
            pairs.update(zip([None, *seq], seq))
            v2 |= set(seq)
    assert (n, v) == (sum(words.values()), len(v2))
    want = Counter()
    for d, t, *_ in rows:
        seq = tokens(t)
        score = 0.0
        for prev, tok in zip([None, *seq], seq):
            cv = words[prev]
            k = min(op10_lm.BUCKETS - 1, math.ceil(math.log2(1 + cv)))
            score += math.log10(lam[k, 0] / (v + 1) + lam[k, 1] * words[tok] / n + lam[k, 2] * pairs[prev, tok] / max(cv, 1))
        want[str(d), round(score, 6)] += 1
    got = Counter((str(r.doc_id), round(r.score, 6)) for r in op10_lm.scored(docs).collect())
    off = [(d, s) for d, s in got if not any(x == d and abs(s - y) < 1e-5 for x, y in want)]
    assert not off and sum(got.values()) == len(rows)


# -- op9

def test_scores_are_sums_of_table_entries(spark):
    docs, labels = C.table(spark, "/root/testdata/sf0.001", "documents"), C.table(spark, "/root/testdata/sf0.001", "labels")
    rows = C.written(op9_quality.measured(docs), "test")
    model = op9_quality.fitted(rows, labels, F.col("rest") != 1)
    assert model.pairs
    names = rows.columns
    for r, s in zip(sorted(rows.collect(), key=lambda r: r[0]), sorted(op9_quality.scored(rows, model).collect(), key=lambda r: r.doc_id)):
        x = np.array([r[names.index("x")]], np.float32)
        fine, coarse = model.binned(x)
        logit = model.intercept
        for f, table in enumerate(model.main):
            logit += float(table[fine[f][0]])
        for a, b, table in model.pairs:
            logit += float(table[coarse[a][0]][coarse[b][0]])
        assert abs(s.score - 1 / (1 + math.exp(-logit))) < 1e-9 and s.doc_id == r[0]


# -- op6

def binomial_below(n, k, p):
    return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


def test_cutoffs_and_verdicts(spark):
    """Cutoffs by exact binomial sums in plain Python; verdicts by applying them one by one."""
    rng, alpha, delta, gain = random.Random(8), 0.05, 0.2, 0.02
    rules = [f"r{i}" for i in range(op6_rules.N_RULES)]
    rows = []
    for stratum in ("a", "b", None):
        for _ in range(400):
            good = rng.random() < .7
            rows.append((stratum, good, [(r, min(1000, int(rng.expovariate(1 / (20 if good or i > 2 else 200))))) for i, r in enumerate(rules)]))
    df = spark.createDataFrame(rows, "stratum string, good boolean, bins array<struct<rule:string,bin:int>>")
    got = {(r.stratum, r.rule): r.cutoff for r in op6_rules.thresholds(df, alpha, delta, gain).collect()}
    want = {}
    for stratum in ("a", "b", None):
        for i, rule in enumerate(rules):
            good = [b[i][1] for s, g, b in rows if s == stratum and g]
            bad = [b[i][1] for s, g, b in rows if s == stratum and not g]
            best = None
            for cut in sorted({b for b in good + bad if b > 0}, reverse=True):
                k, r = sum(b >= cut for b in good), sum(b >= cut for b in bad)
                if k > len(good) * alpha or binomial_below(len(good), k, alpha) > delta / (op6_rules.N_RULES * 3):
                    break
                g = r / len(bad) - k / len(good)
                if g >= gain and (best is None or g > best[0] + 1e-12):
                    best = (g, cut)
            if best:
                want[stratum, rule] = best[1]
    assert got == want and want


def test_false_rejections_stay_below_the_bound_of_each_rule(spark):
    """In repeated draws the certified cutoffs of one rule rarely reject more good documents than alpha says."""
    rng, alpha, over = np.random.default_rng(2), 0.05, 0
    draws = []
    for k in range(40):
        bins = np.minimum(1000, rng.exponential(60, 600)).astype(int)
        good = rng.random(600) < 0.8
        bins = np.where(good, bins, np.minimum(1000, bins * 4))
        draws += [(f"s{k}", bool(g), [(f"r{i}", int(b) if i == 0 else 0) for i in range(op6_rules.N_RULES)]) for g, b in zip(good, bins)]
    df = spark.createDataFrame(draws, "stratum string, good boolean, bins array<struct<rule:string,bin:int>>")
    cutoffs = {r.stratum: r.cutoff for r in op6_rules.thresholds(df, alpha, 0.5, 0.01).collect()}
    over = sum(math.exp(-c / 60) > alpha for c in cutoffs.values())     # the true share of good documents that a cutoff rejects
    assert len(cutoffs) > 5 and over <= 2


def test_verdict_of_a_document(spark, docs):
    measured = op6_rules.measures(docs)
    rows = C.written(measured, "test")
    strata = [r[0] for r in rows.select("stratum").distinct().collect()]
    cut = {s: {"symbols": 30, "repeats": 200} if i % 2 else {"long_words": 150} for i, s in enumerate(sorted(strata, key=str))}
    table = spark.createDataFrame([(s, c) for s, c in cut.items()], "rs string, cutoffs map<string,int>")
    for r in op6_rules.verdicts(rows.withColumn("b", op6_rules.rule_bins()), table).collect():
        bins = {b.rule: b.bin for b in r.b}
        assert r.kept == (not r.base_failed and not any(bins[k] >= c for k, c in cut[r.stratum].items()))


