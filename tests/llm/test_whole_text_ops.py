"""Operators against brute force on a small table with every odd case."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCUMENTS
from traitflow.llm import op1_substrings, op2_decontamination, op4_jaccard, op6_rules, op7_mixing, op10_lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def test_no_rows(none):
    items = none.select(F.col("doc_id").alias("item_id"), "text")
    labels = none.select("doc_id", F.lit(1).alias("quality"))
    assert op1_substrings.deduplicated(none).collect() == []
    assert op2_decontamination.contamination(none, items).collect() == []
    assert op4_jaccard.similar(none).collect() == []
    assert op4_jaccard.one_of_each(none).collect() == []
    assert op6_rules.judged(none, labels).collect() == []
    assert op7_mixing.mix(none).collect() == []
    assert op10_lm.scored(none).collect() == []


# -- op1

def removed(texts):
    """texts in document order -> (bytes removed, runs, kept) by definition."""
    seen, out = set(), []
    for raw in texts:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            w = raw[i:i + 100]
            if w in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(w)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


@pytest.mark.parametrize("hot", [1, 10 ** 9])
def test_substrings(spark, plain, hot):
    plain = [r for r in plain if r[0] != 109] + [(200, plain[3][1][50:] + plain[4][1], *plain[0][2:])]
    want = dict(zip(sorted(r[0] for r in plain), removed([(r[1] or "").encode() for r in sorted(plain, key=lambda r: r[0])])))
    got = op1_substrings.deduplicated(spark.createDataFrame(plain, DOCUMENTS).repartition(4), hot=hot).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {k: (n, s, hashlib.sha256(x).hexdigest()) for k, (n, s, x) in want.items()}
    assert all(bytes(r.kept) == want[r.doc_id][2] for r in got)


def test_substrings_repeated_and_null_ids(docs, rows):
    got = op1_substrings.deduplicated(docs).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((r[0], len((r[1] or "").encode())) for r in rows)
    order = sorted({(r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest(), r[1] or "") for r in rows})
    want = {k[:3]: v for k, v in zip(order, removed([k[3].encode() for k in order]))}
    for r in got:
        options = [v for k, v in want.items() if k[:2] == (r.doc_id is not None, r.doc_id or 0)]
        assert (r.n_removed, r.n_spans, bytes(r.kept)) in options


def test_long_text_in_pieces(spark, monkeypatch, plain):
    big = " ".join(r[1] or "" for r in plain) * 2
    rows = [(1, big, *plain[0][2:])]
    want = removed([big.encode()])[0]
    monkeypatch.setattr(op1_substrings, "BLOCK", 1000)
    got = op1_substrings.deduplicated(spark.createDataFrame(rows, DOCUMENTS)).first()
    assert (got.n_removed, got.n_spans, bytes(got.kept)) == want


# -- op2

def windows(text, pattern=re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
    w = pattern.findall(lower(text or ""))
    return w, {tuple(w[i:i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()


def test_contamination(spark, docs, rows):
    words = (rows[9][1] or "").split()
    texts = {1: " ".join(words[5:25]), 2: " ".join(words[30:33]), 3: "ONE", 4: "", 5: None, 6: rows[13][1].upper(), 7: " ".join(words[40:49]), None: "lonely   words, only", 8: "never seen words here at all"}
    items = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "item_id long, text string, row string")
    got = op2_decontamination.contamination(docs, items).collect()
    wins = {k: windows(v)[1] for k, v in texts.items()}
    expected = Counter()
    for r in rows:
        w, _ = windows(r[1])
        hit, found = set(), set()
        for k, ws in wins.items():
            for win in ws:
                for i in range(len(w) - len(win) + 1):
                    if tuple(w[i:i + len(win)]) == win:
                        hit |= set(range(i, i + len(win)))
                        found.add(k)
        listed = ",".join(sorted(str(k) for k in found if k is not None))
        expected[(r[0], len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == expected
    assert sum(v for k, v in expected.items() if k[-1]) > 5
    clean = op2_decontamination.clean_documents(docs, items)
    assert clean.schema == docs.schema
    assert Counter(r.doc_id for r in clean.collect()) == Counter(k[0] for k in expected.elements() if not k[-1])


# -- op4

def shingles(text, n):
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_similar(docs, rows, n, percent):
    sets = [shingles(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and sets[j]:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(i)
    expected = Counter()
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            expected[(rows[i][0], len(sets[i]), min(ids) if ids else None)] += 1
    got = op4_jaccard.similar(docs, n, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    assert max(len(m) for m in groups.values()) >= 3
    stay = op4_jaccard.one_of_each(docs, n, percent)
    assert stay.schema == docs.schema
    blank = sum(not s for s in sets)
    assert stay.count() == blank + sum(1 for m in groups.values() if sets[m[0]])


# -- op6

def test_rules_base(docs, rows):
    expected = Counter()
    for r in rows:
        t = r[1] or ""
        w = WORD.findall(t)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        times = Counter(grams)
        cover = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        expected[(r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w))] += 1
    got = op6_rules.measures(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == expected


def test_wide_places(docs, monkeypatch):
    usual = {(r.doc_id, r.word_chars): r.n_repeat_words for r in op6_rules.measures(docs).collect()}
    monkeypatch.setattr(op6_rules, "POSITION_BITS", 1)     # every text counts as very long
    assert {(r.doc_id, r.word_chars): r.n_repeat_words for r in op6_rules.measures(docs).collect()} == usual


def test_binomial(spark):
    def exact(n, k, p):
        return sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1))
    cases = [(1, 0), (10, 0), (10, 3), (10, 10), (400, 1), (1000, 4), (3000, 20)]
    got = spark.createDataFrame(cases, "n long, k long").select("n", "k", op6_rules.binomial_below(F.col("n"), F.col("k"), 0.005).alias("p")).collect()
    assert all(abs(r.p - exact(r.n, r.k, 0.005)) < 1e-9 for r in got)


def test_thresholds(spark):
    # good documents of stratum a lie below bin 100, bad ones above 300; stratum b is too small to certify anything
    marked = [("a", 20 + i % 80, True) for i in range(4000)] + [("a", 300 + i % 50, False) for i in range(300)] + [("b", 5, True)] * 50 + [("b", 900, False)] * 50 + [(None, 7, True)] * 4000
    rows = spark.createDataFrame(marked, "stratum string, bin int, good boolean").select("stratum", "good", F.array(F.struct(F.lit("symbols").alias("rule"), "bin")).alias("bins"))
    got = op6_rules.thresholds(rows).collect()
    assert [(r.stratum, r.rule) for r in got] == [("a", "symbols")] and 99 < got[0].cutoff <= 300


# -- op7

def test_mix(docs, rows):
    got = op7_mixing.mix(docs).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, target = set(), {}
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        target = {s: 2 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in order if x not in full) for s in order}
        over = {s for s in order if target[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
    by = {(r.source_size, round(r.target, 6)) for r in got}
    assert by == {(size[s], round(target[s], 6)) for s in order}
    taken = Counter()
    for r in got:
        taken[r.source_size] += r.taken
    for s in order:
        assert abs(taken[size[s]] - target[s]) <= max(20, 0.02 * target[s])
    assert sorted(map(str, op7_mixing.mix(docs.repartition(5)).collect())) == sorted(map(str, got))


# -- op10

def test_language_model(docs, rows):
    tokens = [(r[0], WORD.findall(lower(r[1] or "")) + ["\0"]) for r in rows]
    part = [zlib.crc32(("" if d is None else str(d)).encode()) % 10 for d, _ in tokens]
    one, two = Counter(), Counter()
    for (_, t), p in zip(tokens, part):
        if p:
            one.update(t)
    n, v = sum(one.values()), len(one)
    expected = Counter((d, p == 0, len(t), sum(one[w] > 0 for w in t), n, round(sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 4)) for (d, t), p in zip(tokens, part))
    got = op10_lm.scored(docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    # the same whatever the blocks
    again = op10_lm.scored(docs.repartition(7)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.score, 6)) for r in again) == sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.score, 6)) for r in got)


def test_language_model_gains(spark, rows):
    """On held-out documents of the same kind the model is better than the smoothed unigrams, and proper: brute force agrees with the mixture."""
    path = "/root/testdata/sf0.001/documents.parquet"
    got = [r for r in op10_lm.scored(spark.read.parquet(path)).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.95 * sum(r.base_score for r in got)
