"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text's encoding is an element of a monoid: two neighbours are joined without encoding both again. The same
reduction runs on two levels.

* Text: halves are cut down to ``LEAF_CHARS`` characters and split by the pattern. To join two halves, the left one
  gives up its last matches until every kept match ends ``REACH`` characters before the cut (a match depends on
  no character further than that behind it); they and the first matches of the right half are split again, in a window
  that doubles until one of its boundaries is also a boundary of the right half. A match depends only on what
  follows its start, so everything behind that boundary stands.
* Match: a match that is no entry of the vocabulary is cut in halves down to ``LEAF_BYTES`` bytes, which are merged
  by rank (the lowest first, then the leftmost). To join two halves, a window of tokens around the cut is merged
  again; it doubles until its first and last token are those that stood there before. Merges that would cross
  a boundary between two tokens would also cross it in the encoding of these two tokens alone, so a sequence is the
  encoding of its bytes if and only if every neighbouring pair is that of its own; the pairs outside and at the
  edge of a stable window are unchanged, so the tokens outside are proved.

Decoding concatenates the tokens' bytes up the same tree. Distinct matches are encoded once per worker (a cache of
bounded size). One pass over the table, no shuffle.

Edge cases: a null or empty text has no tokens (the digests are those of no bytes); bytes that are not UTF-8 are read as
U+FFFD; ids that the vocabulary lacks fail the job in ``decoded``; repeated rows and null ids give a row each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C
from traitflow.llm import textnum as N

LEAF_CHARS = 1 << 16
LEAF_BYTES = 64
REACH = 3               # characters behind a match that can decide it: "'ll" and white space before a word
CACHE = 1 << 19         # distinct matches kept by a worker
BLOCK = 8 << 20         # bytes of text encoded before rows are handed on


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary of a .tiktoken file: token bytes -> rank, which is its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.leaf_chars, self.leaf_bytes = leaf_chars, leaf_bytes
        self.known: dict[str, bytes] = {}
        self.tokens = {i: token for token, i in ranks.items()}

    # --- text level: elements are lists of matches -------------------------------------------------

    def split(self, text: str) -> list[str]:
        if len(text) <= self.leaf_chars:
            return self.pattern.findall(text)
        half = len(text) // 2
        return self.joined_matches(self.split(text[:half]), self.split(text[half:]))

    def joined_matches(self, left: list[str], right: list[str]) -> list[str]:
        loose = 0
        keep = len(left)
        while keep and loose < REACH:
            keep -= 1
            loose += len(left[keep])
        head, take = "".join(left[keep:]), 4
        while True:
            window = head + "".join(right[:take])
            found = self.pattern.findall(window)
            if take >= len(right):
                return left[:keep] + found
            cuts, at = {}, len(head)
            for k, m in enumerate(right[:take]):
                cuts[at] = k
                at += len(m)
            at = 0
            for k, m in enumerate(found):
                if at in cuts and at + REACH <= len(window):
                    return left[:keep] + found[:k] + right[cuts[at]:]
                at += len(m)
            take *= 2

    # --- match level: elements are lists of token bytes ---------------------------------------------

    def merged(self, raw: bytes) -> list[bytes]:
        if len(raw) <= self.leaf_bytes:
            return self.by_rank(raw)
        half = len(raw) // 2
        return self.joined_tokens(self.merged(raw[:half]), self.merged(raw[half:]))

    def joined_tokens(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        w = 1
        while True:
            a, b = left[-w:], right[:w]
            new = self.by_rank(b"".join(a) + b"".join(b))
            if (w >= len(left) or new[0] == a[0]) and (w >= len(right) or new[-1] == b[-1]):
                return left[:-w] + new + right[w:]
            w *= 2

    def by_rank(self, raw: bytes, last: bool = False) -> list[bytes]:
        """Merges of neighbours, lowest rank first, then leftmost, until none is in the vocabulary. With ``last`` the
        merge that would make all one token is not done."""
        n, ranks = len(raw), self.ranks
        end = list(range(1, n + 1))         # end of the part that starts at i
        before = list(range(-1, n))         # start of the part before
        live = [True] * n
        queue = [(r, i) for i in range(n - 1) if (r := ranks.get(raw[i:i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            if not live[i] or end[i] == n:
                continue
            j = end[i]
            if ranks.get(raw[i:end[j]]) != r:
                continue                    # one of the two parts has grown
            if last and i == 0 and end[j] == n:
                continue
            live[j] = False
            end[i] = end[j]
            if end[i] < n:
                before[end[i]] = i
                if (s := ranks.get(raw[i:end[end[i]]])) is not None:
                    heapq.heappush(queue, (s, i))
            p = before[i]
            if p >= 0 and (s := ranks.get(raw[p:end[i]])) is not None:
                heapq.heappush(queue, (s, p))
        out, i = [], 0
        while i < n:
            out.append(raw[i:end[i]])
            i = end[i]
        return out

    # --- interface ------------------------------------------------------------------------------------

    def match_ids(self, match: str) -> bytes:
        raw = match.encode("utf-8")
        whole = self.ranks.get(raw)
        ids = [whole] if whole is not None else [self.ranks[t] for t in self.merged(raw)]
        out = np.array(ids, "<u4").tobytes()
        if len(raw) <= 256:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[match] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        known = self.known
        return b"".join([known.get(m) or self.match_ids(m) for m in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        if len(ids) <= 4 * self.leaf_chars:
            return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _over_binary(make, schema: str):
    """mapInArrow function: (doc_id, binary) -> (doc_id, ``make()`` of it), block by block."""
    def run(batches):
        convert = make()
        for batch in batches:
            for i, j in N.blocks(batch.column(1), BLOCK):
                part = batch.slice(i, j - i)
                out = [convert(v) for v in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], names=schema.split(","))
    return run


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers) of every row of ``docs``. The vocabulary goes to
    the workers once, as a broadcast variable of the file's size."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def make():
        bpe = Bpe(*shared.value)
        return lambda raw: bpe.encode(raw.decode("utf-8", "replace")) if raw else b""

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary")).mapInArrow(_over_binary(make, "doc_id,ids"), "doc_id long, ids binary")


def decoded(rows: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, raw (the bytes that ``ids`` stand for)."""
    shared = rows.sparkSession.sparkContext.broadcast((ranks, pattern))

    def make():
        bpe = Bpe(*shared.value)
        return lambda ids: bpe.decode(ids) if ids else b""

    return rows.select("doc_id", "ids").mapInArrow(_over_binary(make, "doc_id,raw"), "doc_id long, raw binary")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, ids, raw: encoding and what it decodes to, in one pass over ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches):
        bpe = Bpe(*shared.value)
        for batch in batches:
            for i, j in N.blocks(batch.column(1), BLOCK):
                part = batch.slice(i, j - i)
                ids = [bpe.encode(raw.decode("utf-8", "replace")) if raw else b"" for raw in part.column(1).to_pylist()]
                raw = [bpe.decode(v) for v in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(raw, pa.binary())], names=["doc_id", "ids", "raw"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, ids binary, raw binary")


def query(spark: SparkSession, sf_dir: str, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    import public_tokenizers as P
    ranks = read_ranks(ranks_path or P.path("byte_bpe_multi_50k.tiktoken"))
    both = round_trip(C.table(spark, sf_dir, "documents"), ranks, pattern or P.PATTERN)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"))
