"""Byte-level BPE against the tokenizer library and exact round trips."""

import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from traitflow.llm import op12_bpe as B  # noqa: E402


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def peer(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def texts(rng):
    odd = ["", " ", "  ", "a", "'", "'ll", "we'll  go", "\n\n  x", "0123456789" * 30, "é" * 400, "日本語のテキスト" * 40, "\U0001F600" * 90, "a" * 3000, "ab" * 900,
           "<|endoftext|> plain", "\x00\x01\x02", "tab\t\ttab \t x", "x" + " " * 700 + "y", "=" * 513, "   a", "word'" * 200, "ß'S 'RE 're", "�"]
    alphabet = ["a", "b", " ", "  ", "'", "'s", "'ll", "1", "é", "日", "\n", "\t", "!", "\U0001F600", "the", " of", " ", "ZZ"]
    return odd + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 400))) for _ in range(150)]


@pytest.mark.parametrize("leaf_chars,leaf_bytes", [(1 << 16, 64), (64, 8), (7, 2), (3, 1)])
def test_tree_equals_library(ranks, peer, leaf_chars, leaf_bytes):
    """Whatever the leaves' size: each join has to find the same tokens."""
    bpe = B.Bpe(ranks, P.PATTERN, leaf_chars, leaf_bytes)
    for t in texts(random.Random(leaf_chars)):
        assert bpe.split(t) == bpe.pattern.findall(t)
        assert ids(bpe.encode(t)) == peer.encode_ordinary(t), t[:50]
        assert bpe.decode(bpe.encode(t)) == t.encode()


def test_unreachable_tokens_and_split_dependence():
    """A vocabulary whose entries are not all made by its merges, and where merging order depends on neighbours."""
    words = [bytes([c]) for c in b"abcd"] + [b"bc", b"abcd", b"ab", b"cd", b"abc", b"dd", b"ddd", b"da"]
    ranks = {w: i for i, w in enumerate(words)}
    peer = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    for leaf in (1, 2, 5, 64):
        bpe = B.Bpe(ranks, r"\S+|\s+", leaf_bytes=leaf)
        for _ in range(400):
            t = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 60)))
            assert ids(bpe.encode(t)) == peer.encode_ordinary(t), t


def test_long_runs(ranks, peer):
    bpe = B.Bpe(ranks, P.PATTERN)
    for t in ("a" * 50_000, "xyz" * 20_000, " " * 100_000 + "end", "word " * 60_000):
        assert ids(bpe.encode(t)) == peer.encode_ordinary(t)


def test_query_rows(spark, docs, none, rows, ranks, peer):
    import hashlib
    out = B.round_trip(docs, ranks, P.PATTERN).collect()
    want = sorted((str(r[0]), tuple(peer.encode_ordinary(r[1] or ""))) for r in rows)
    assert sorted((str(r.doc_id), tuple(ids(bytes(r.ids)))) for r in out) == want
    assert sorted(bytes(r.raw) for r in out) == sorted((r[1] or "").encode() for r in rows)
    assert B.round_trip(none, ranks, P.PATTERN).count() == 0
    enc = B.encoded(docs, ranks, P.PATTERN)
    assert sorted(bytes(r.raw) for r in B.decoded(enc, ranks, P.PATTERN).collect()) == sorted((r[1] or "").encode() for r in rows)
    spark.createDataFrame(rows, docs.schema).write.mode("overwrite").parquet(path := B.C.staging_path(spark, "bpe-docs") + "/documents.parquet")
    q = {(r.doc_id, r.ids_sha256): r for r in B.query(spark, path.rsplit("/", 1)[0]).collect()}
    for d, t, *_ in rows:
        e = np.array(peer.encode_ordinary(t or ""), "<u4").tobytes()
        r = q[d, hashlib.sha256(e).hexdigest()]
        assert r.n_tokens == len(e) // 4 and r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
