"""Cross-tokenizer alignment against brute force; bitmaps against plain sets."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")

from tests.llm.conftest import DOCUMENTS  # noqa: E402
from traitflow.llm import op11_alignment as A  # noqa: E402


@pytest.fixture(scope="module")
def files():
    return open(P.path("byte_bpe_50k.json"), encoding="utf-8").read(), open(P.path("piece_bpe_32k.model"), "rb").read()


def brute(files, rows):
    one, two = A.ByteLevel(files[0]), A.Pieces(files[1])
    docs, holds = [], Counter()
    for doc, text in rows:
        raw = b" " + (text or "").encode()
        x = one.encode([text or ""])[0] if text else []
        y = two.encode([text or ""])[0] if text else []
        if not text or b"".join(one.bytes[t] for t in x) != raw or b"".join(two.bytes[t] for t in y) != raw:
            docs.append((doc, [], Counter(), 0, 0))
            continue
        groups, i, j = [], 0, 0
        while i < len(x):
            ga, gb = [x[i]], [y[j]]
            la, lb = len(one.bytes[x[i]]), len(two.bytes[y[j]])
            i, j = i + 1, j + 1
            while la != lb:
                if la < lb:
                    ga.append(x[i])
                    la += len(one.bytes[x[i]])
                    i += 1
                else:
                    gb.append(y[j])
                    lb += len(two.bytes[y[j]])
                    j += 1
            groups.append((ga, gb))
        links = Counter((a, b) for ga, gb in groups for a in ga for b in gb)
        holds.update(set(links))
        docs.append((doc, groups, links, len(x), len(y)))
    top = defaultdict(int)
    for (a, _), n in holds.items():
        top[a] = max(top[a], n)
    out = []
    for doc, groups, links, na, nb in docs:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((doc, na, nb, len(groups), sum(links.values()), sum(n for p, n in links.items() if holds[p] == top[p[0]]),
                    sum(n * holds[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, holds, top


def test_ranked_is_the_same_tokenizer(files):
    """The proof holds for this file, fails for lists that merge otherwise, and the texts agree."""
    assert A.can_be_ranked(files[0])
    slow, fast = A.ByteLevel(files[0]), A.ByteLevel(files[0], True)
    rng = random.Random(9)
    texts = [t for t in some_texts(rng) if t] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(9, 14), rng.randrange(0, 0x300), 32, 32])) for _ in range(300)) for _ in range(200)]
    assert [list(x) for x in fast.encode(texts)] == slow.encode(texts)
    single = [bytes([c]) for c in b"abcd"]
    ranks = {w: i for i, w in enumerate([*single, b"ab", b"bc", b"abc", b"abcd"])}
    pairs = [(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"abc", b"d")]
    assert A.same_merges(ranks, pairs)
    assert not A.same_merges(ranks, pairs[:2] + [(b"a", b"bc"), pairs[3]])        # by rank ab is merged first
    assert not A.same_merges(ranks, [pairs[1], pairs[0], *pairs[2:]])            # other order
    assert not A.same_merges(ranks, pairs[:2] + [pairs[3]])                       # abc is in no merge


def some_texts(rng):
    alphabet = ["the", " of", " ", "  ", "\n", "\t", "1234", "é", "日本", "\U0001F600", "zq", "Straße", "'s", "!", "▁", "<s>", "<|endoftext|>", "<0x41>", "http://x.y/z?a=1"]
    return (["", None, "a", " ", "   ", "\n", "▁", "<|endoftext|> <s> </s> <unk> <0x41>", "\U0001F600" * 50, "x" * 900, "\x00\x01", "日" * 200, "é" * 333, " lead", "trail  "]
            + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(60)] + ["the house of the house"] * 25)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block,piece", [(4 << 20, 1 << 21), (300, 7)])
def test_alignment_equals_brute_force(spark, files, monkeypatch, block, piece):
    monkeypatch.setattr(A, "BLOCK", block)
    monkeypatch.setattr(A, "SLICE", piece)
    rows = [(k if k % 9 else None, t) for k, t in enumerate(some_texts(random.Random(block)))]
    df = spark.createDataFrame([(d, t, "en", "s", None, "x", "y", "z", "r", "k", "g", "c") for d, t in rows], DOCUMENTS).repartition(4)
    got, pairs = A.alignment(df, *files)
    want, holds, top = brute(files, rows)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted([tuple(r[c] for c in COLUMNS) for r in got.collect()], key=key) == sorted(want, key=key)
    links = Counter()
    for r in pairs.collect():
        assert r.n_docs == holds[r.a, r.b] and r.best == (holds[r.a, r.b] == top[r.a])
        links[r.a, r.b] = r.links
    assert set(links) == set(holds)
    assert sum(r[4] for r in want) == sum(links.values())


def test_query_on_driver_rows(spark, docs, rows, none, files):
    got, _ = A.alignment(docs, *files)
    key = lambda r: tuple(str(v) for v in r)
    want = brute(files, [r[:2] for r in rows])[0]
    assert sorted([tuple(r[c] for c in COLUMNS) for r in got.collect()], key=key) == sorted(want, key=key)
    assert A.alignment(none, *files)[0].count() == 0


@pytest.mark.parametrize("n_docs", [1, 2, 15, 16, 17, 300, 5000])
def test_planes(n_docs):
    """Planes give back documents and links, sparse and dense."""
    rng = np.random.default_rng(n_docs)
    keys, links = [], []
    for a in range(40):
        docs = np.flatnonzero(rng.random(n_docs) < rng.random() ** 3)
        keys.append(A.Aligned.key(np.full(len(docs), a), np.full(len(docs), 7 * a), docs))
        links.append(rng.integers(1, [2, 4, 100_000][a % 3], len(docs)))
    keys, links = np.concatenate(keys), np.concatenate(links)
    a, b, n, total, planes = A.postings(keys, links, n_docs)
    pair, doc = keys >> 16, keys & 65535
    assert (a << 20 | b).tolist() == sorted(set(pair.tolist())) and n.sum() == len(keys) and total.sum() == links.sum()
    best, count = rng.random(len(a)) < .5, rng.integers(1, 1 << 40, len(a))
    x, y = A.weighted(planes, n_docs, best, count)
    at = np.searchsorted(a << 20 | b, pair)
    wx, wy = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    np.add.at(wx, doc, links * best[at])
    np.add.at(wy, doc, links * count[at])
    assert x.tolist() == wx.tolist() and y.tolist() == wy.tolist()
    half = planes.slice(len(a) // 2)
    x2, _ = A.weighted(half, n_docs, best[len(a) // 2:], count[len(a) // 2:])
    x1, _ = A.weighted(planes.slice(0, len(a) // 2), n_docs, best[:len(a) // 2], count[:len(a) // 2])
    assert (x1 + x2).tolist() == x.tolist()
