"""Near copies around the limit, and words that sums of byte values cannot tell apart."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import DOCUMENTS
from traitflow.llm import op4_jaccard as J
from traitflow.llm import op10_lm
from traitflow.llm import textnum as N


def frame(spark, texts):
    return spark.createDataFrame([(i, t, *([None] * 10)) for i, t in enumerate(texts)], DOCUMENTS).repartition(4)


def components(texts, words, percent):
    sets = [J.plain_set(t, words) for t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    links = 0
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                links += 1
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [root(i) for i in range(len(texts))], links


def copies(seed, n, edits):
    """Copies of one text, each with a few words changed: similarities of 0.7 to 0.85 at five words."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(200)]
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(200), rng.choice(edits)):
            w[at] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("edits", [(2, 3, 3, 3), (1, 3, 4)])
def test_five_hundred_near_copies(spark, monkeypatch, edits):
    """Exact components, and far fewer pairs than the group has."""
    texts = copies(len(edits), 500, edits) + [f"other text number {i} of its own" for i in range(20)]
    want, links = components(texts, 5, 80)
    made, real = {}, J.C.written

    def counting(df, name):
        out = real(df, name)
        made[name] = made.get(name, 0) + out.count() if name in ("jac-rest", "jac-stars") else 0
        return out
    monkeypatch.setattr(J.C, "written", counting)
    got = {r.doc_id: r.component_id for r in J.similar(frame(spark, texts), 5, 80).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) > 5
    assert made["jac-stars"] + made["jac-rest"] < 8 * 500 + 1.5 * links, (made, links)


def thue_morse(k, a, b):
    word = a
    other = b
    for _ in range(k):
        word, other = word + other, other + word
    return word, other


@pytest.mark.parametrize("k", [10, 12])
def test_long_words_keep_apart(spark, k):
    one, two = thue_morse(k, "a", "b")
    texts = [f"one two three {one}", f"one two three {two}", f"one two three {one}"]
    rows = {r.doc_id: r.component_id for r in J.similar(frame(spark, texts)).collect()}
    assert rows == {0: 0, 1: 1, 2: 0}
    raw, offsets = N.concatenated(pa.array([one + " " + two]))
    h, counts = N.word_hashes(raw, offsets)
    assert counts.tolist() == [2] and h[0] != h[1]


def test_word_hashes_depend_on_the_word_alone():
    words = ["a", "A", "ab", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "é" * 9, "x" * 5000, "\x00", "\x00\x00", "日本語"]
    alone = [N.word_hashes(*N.concatenated(pa.array([w])))[0][0] for w in words]
    together, counts = N.word_hashes(*N.concatenated(pa.array([" ".join(words), None, "", "  " + "\t\n".join(words[::-1])])))
    assert counts.tolist() == [len(words), 0, 0, len(words)]
    assert together.tolist() == alone + alone[::-1]
    assert alone[0] == alone[1] and len(set(alone)) == len(words) - 1
    rng = np.random.default_rng(3)
    many = {bytes(rng.integers(33, 127, rng.integers(1, 30), dtype=np.uint8)).lower() for _ in range(20000)}
    h, _ = N.word_hashes(*N.concatenated(pa.array([w.decode() for w in many])))
    assert len(set(h.tolist())) == len(many)


def test_language_model_counts_long_words_apart(spark):
    one, two = thue_morse(11, "a", "b")
    train = sum(zlib.crc32(str(i).encode()) % 10 != 0 for i in range(40))
    n, v = 4 * train, 3
    want = sum(k * math.log10((k * train + 0.1) / (n + 0.1 * (v + 1))) for k in (2, 1, 1))
    rows = op10_lm.scored(frame(spark, [f"{one} {two} {one}"] * 40)).collect()
    assert len(rows) == 40 and all(r.n_tokens == 4 and r.train_tokens == n and abs(r.base_score - want) < 1e-9 for r in rows)
