"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Each text is encoded by a byte-level BPE (A, of a space and the text) and by a piece model (B, which adds that space
itself). Byte offsets at which tokens of both end cut the text into groups; inside a group every A token is linked
with every B token.

* Postings: documents are encoded in blocks. For each id pair of a block there is one posting: bitmaps over the block's
  documents, one per binary digit of the document's number of links (multiplicity planes), each a sorted list
  of 16-bit places or, where that is larger, plain bits. The planes are OR-merged and popcounted for the number of
  documents, and popcounted with their weights for the number of links. Blocks hold different
  documents, so the counts of a pair's postings add.
* Counts: Spark adds them per (pair, bucket of blocks) and then per pair, takes the maximum per A id, and sends count and
  flag back to the pair's postings by the same buckets. There are about as many buckets as the root of the number of blocks, so the most
  frequent pair, which has a posting in every block, meets in no task.
* Scores: postings go to their block, whose documents add up ``2 ** plane`` times flag and count.

Occurrences of links are never listed: a group counts as (distinct A ids, times) x (distinct B ids, times), a slice at a time.

Edge cases: texts that are null or empty, or that A or B do not give back byte by byte (with the space), have no tokens and
zeros everywhere; special tokens' strings are plain text; bytes that are not UTF-8 are read as U+FFFD; equal rows count
each; ids may be null or repeat; very long texts are a block of their own; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C
from traitflow.llm import textnum as N
from traitflow.llm.op12_bpe import Bpe

BLOCK = 4 << 20         # bytes of text in a block
BLOCK_ROWS = 1 << 14    # documents in a block at most; places are 16 bits
SLICE = 1 << 21         # id pairs of large groups expanded at once
_ID, _DOC = 20, 16      # bits of an id and of a place
# Fixed value: the split of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def same_merges(ranks: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> bool:
    """Merging neighbours by the rank of their bytes gives what the list of merges gives, for every text. Up to the merge that makes a token,
    its bytes merge as they do alone (no merge crosses their ends), so it is enough that every entry, merged alone by
    rank, is made last from the pair that the list names, and that ranks rise along the list."""
    made = {x + y: (x, y) for x, y in merges}
    order = [ranks.get(x + y, -1) for x, y in merges]
    if len(made) != len(merges) or order != sorted(set(order)) or order[:1] == [-1]:
        return False
    bpe = Bpe(ranks, ".")
    for token in ranks:
        if len(token) > 1:
            end = bpe.by_rank(token, last=True)
            if len(end) == 2 and made.get(token) != tuple(end):
                return False
            if len(end) > 2 and token in made:
                return False
    return True


class ByteLevel:
    """Tokenizer A from the text of its .json file. ``ranked``: ``same_merges`` holds, so texts of common characters go through the faster
    library; characters on whose class two libraries' tables may differ go through the file's own."""

    def __init__(self, spec: str, ranked: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.bytes = []
        for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True)):
            token = self.tokenizer.id_to_token(i) or ""
            self.bytes.append(bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode())
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)
        self.ranked = None
        if ranked:
            import tiktoken
            self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=read_vocabulary(spec)[0], special_tokens={})
            self.unusual = re.compile("[\x1c-\x1f\x85\xa0\u0250-\U0010ffff]")

    def encode(self, texts: list[str]) -> list:
        if self.ranked is None:
            return self.by_file(texts)
        out = [None if self.unusual.search(t) else self.ranked.encode_to_numpy(" " + t) for t in texts]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(rest, self.by_file([texts[k] for k in rest])):
            out[k] = x
        return out

    def by_file(self, texts: list[str]) -> list[list[int]]:
        batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in batch([" " + t for t in texts], add_special_tokens=False)]


def read_vocabulary(spec: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]]]:
    """Token bytes -> id, and the merges, of a byte-level BPE file."""
    alphabet = byte_alphabet()
    raw = lambda token: bytes(alphabet[c] for c in token)
    model = json.loads(spec)["model"]
    added = {t["content"] for t in json.loads(spec).get("added_tokens", [])}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return {raw(t): i for t, i in model["vocab"].items() if t not in added}, [(raw(x), raw(y)) for x, y in merges]


def can_be_ranked(spec: str) -> bool:
    """The file is a byte-level BPE with the usual split and nothing else before it, and ``same_merges`` holds."""
    file = json.loads(spec)
    split = file.get("pre_tokenizer") or {}
    plain = (file.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and file["model"].get("type") == "BPE"
             and not any(file["model"].get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")))
    return bool(plain) and same_merges(*read_vocabulary(spec))


class Pieces:
    """Tokenizer B from the bytes of its .model file."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))]
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """Ids of one tokenizer over the texts of a block, one after another."""

    def __init__(self, ids: list[list[int]], lengths: np.ndarray):
        self.counts = np.array([len(x) for x in ids], np.int64)
        self.ids = np.concatenate([np.asarray(x, np.int32) for x in ids]).astype(np.int64) if ids else np.zeros(0, np.int64)
        self.ends = np.cumsum(lengths[self.ids])

    def grouped(self, is_cut: np.ndarray) -> None:
        """``is_cut`` tells for each byte offset whether tokens of both sides end there."""
        self.closes = is_cut[self.ends]
        self.group = np.cumsum(self.closes) - self.closes
        self.sizes = np.bincount(self.group)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the next ``counts[k]`` values for each k."""
    total = np.concatenate([[0], np.cumsum(values)])
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


class Aligned:
    """Groups and links of a block of documents, all of which both tokenizers give back."""

    def __init__(self, a: Side, b: Side):
        in_a, is_cut = np.zeros(a.ends[-1] + 1, bool), np.zeros(a.ends[-1] + 1, bool)
        in_a[a.ends] = True
        cuts = b.ends[in_a[b.ends]]
        is_cut[cuts] = True
        a.grouped(is_cut)
        b.grouped(is_cut)
        self.a, self.b = a, b
        doc_ends = a.ends[np.cumsum(a.counts) - 1]
        self.doc = np.searchsorted(doc_ends, cuts)      # of each group
        self.n_docs = len(doc_ends)
        self.n_groups = np.bincount(self.doc, minlength=self.n_docs)
        self.n_links = sums(a.sizes * b.sizes, self.n_groups)

    def digests(self, name_a: np.ndarray, name_b: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups as text. ``name_a[closes, id]`` is an id with what follows it, ``name_b`` too."""
        a, b = self.a, self.b
        out = np.empty(len(a.ids) + len(b.ids), object)
        out[np.arange(len(a.ids)) + (np.cumsum(b.sizes) - b.sizes)[a.group]] = name_a[a.closes.astype(int), a.ids]
        out[np.arange(len(b.ids)) + np.cumsum(a.sizes)[b.group]] = name_b[b.closes.astype(int), b.ids]
        ends = np.cumsum(a.counts + b.counts).tolist()
        return [hashlib.sha256(b"".join(out[i:j])[:-1]).hexdigest() for i, j in zip([0, *ends[:-1]], ends)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (A id, B id, document) and the links of each."""
        a, b = self.a, self.b
        single = (a.sizes == 1) & (b.sizes == 1)
        one_a, one_b = single[a.group], single[b.group]
        keys = [self.key(a.ids[one_a], b.ids[one_b], self.doc[single])]
        links = [np.ones(len(keys[0]), np.int64)]
        ga, ia, na = distinct(a.group[~one_a], a.ids[~one_a])
        gb, ib, nb = distinct(b.group[~one_b], b.ids[~one_b])
        per = np.bincount(gb, minlength=len(single))        # distinct B ids of each group
        start = np.cumsum(per) - per
        width = per[ga]
        upto = np.cumsum(width)
        i = 0
        while i < len(ga):
            j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + SLICE, side="right")))
            w = width[i:j]
            row = np.repeat(np.arange(i, j), w)
            other = np.arange(len(row)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(start[ga[i:j]], w)
            k, n = added(self.key(ia[row], ib[other], self.doc[ga[row]]), na[row] * nb[other])
            keys.append(k)
            links.append(n)
            i = j
        return added(np.concatenate(keys), np.concatenate(links))

    @staticmethod
    def key(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return (a << (_ID + _DOC)) | (b << _DOC) | doc


def added(keys: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, their links added."""
    if not len(keys):
        return keys, links
    if links.sum() <= 2 * len(links):       # mostly single ones: sorting the keys alone is faster
        keys = np.sort(np.repeat(keys, links))
        first = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], links[order]
    first = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    return keys[first], np.add.reduceat(links, first)


def distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) in order, and how often each occurs."""
    keys, n = added((group << _ID) | ids, np.ones(len(ids), np.int64))
    return keys >> _ID, keys & ((1 << _ID) - 1), n


def dense_size(n_docs):
    """Bytes of plain bits over a block's documents, an even number."""
    return (n_docs + 15) // 16 * 2


def postings(keys: np.ndarray, links: np.ndarray, n_docs: int):
    """a, b, n_docs (OR of the planes, popcounted), n_links and planes (list of bitmaps) of each pair of a block."""
    pair, doc = keys >> _DOC, keys & ((1 << _DOC) - 1)
    first = np.concatenate([[0], np.flatnonzero(np.diff(pair)) + 1]) if len(pair) else np.zeros(0, np.int64)
    which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pair))))
    digits = np.frexp(np.maximum.reduceat(links, first).astype(np.float64))[1] if len(first) else np.zeros(0, np.int64)
    offset = np.concatenate([[0], np.cumsum(digits)]).astype(np.int64)      # of each pair's planes
    at, docs = [], []
    for j in range(int(digits.max(initial=0))):
        has = np.flatnonzero((links >> j) & 1)
        at.append(offset[which[has]] + j)
        docs.append(doc[has])
    at = np.concatenate(at) if at else np.zeros(0, np.int64)
    docs = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    order = np.argsort(at, kind="stable")
    count = np.bincount(at, minlength=int(offset[-1]))
    raw = docs[order].astype("<u2").tobytes()
    end = 2 * np.cumsum(count)
    planes = [raw[i:j] for i, j in zip((end - 2 * count).tolist(), end.tolist())]
    full = dense_size(n_docs)
    for k in np.flatnonzero(2 * count >= full).tolist():
        bits = np.zeros(8 * full, np.uint8)
        bits[np.frombuffer(planes[k], "<u2")] = 1
        planes[k] = np.packbits(bits, bitorder="little").tobytes()
    ids = pair[first]
    return (ids >> _ID, ids & ((1 << _ID) - 1), np.diff(np.append(first, len(pair))),
            np.add.reduceat(links, first) if len(first) else links, pa.ListArray.from_arrays(pa.array(offset, pa.int32()), pa.array(planes, pa.binary())))


def weighted(planes: pa.ListArray, n_docs: int, best: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``links * best`` and ``links * count`` for each document of a block, over postings of that block."""
    lists = planes.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(lists)
    flat = planes.flatten()
    row = np.repeat(np.arange(len(planes)), sizes)
    digit = np.arange(len(row)) - np.repeat(lists[:-1] - lists[0], sizes)
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset:flat.offset + len(flat) + 1].astype(np.int64)
    length = np.diff(offsets)
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(flat) else np.zeros(0, np.uint8)
    out = np.zeros((2, n_docs), np.int64)
    weight = np.stack([best[row].astype(np.int64), count[row]]) << digit
    full = dense_size(n_docs)
    dense = length == full
    places = data.view("<u2")
    owner = np.repeat(np.arange(len(flat)), length // 2)
    listed = ~dense[owner]
    for k in range(2):
        np.add.at(out[k], places[listed], weight[k][owner[listed]])
    base = offsets - offsets[0]
    for i in np.flatnonzero(dense):
        docs = np.flatnonzero(np.unpackbits(data[base[i]:base[i + 1]], bitorder="little"))
        out[:, docs] += weight[:, i:i + 1]
    return out[0], out[1]


SCHEMA = ("doc_id long, block long, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "size int, a int, b int, n_docs int, links long, planes array<binary>")
_ARROW = pa.schema([("doc_id", pa.int64()), ("block", pa.int64()), ("place", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("size", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n_docs", pa.int32()),
                    ("links", pa.int64()), ("planes", pa.list_(pa.binary()))])


def batch_of(n: int, known: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(known[f.name], f.type) if f.name in known else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def names(n: int, inside: bytes, last: bytes) -> np.ndarray:
    return np.array([[b"%d%s" % (i, mark) for i in range(n)] for mark in (inside, last)], object)


def inverted(docs: DataFrame, spec: str, model: bytes) -> DataFrame:
    """Document rows (n_a ... groups_sha256, and their block and place) and posting rows (a, b, n_docs, links, planes of a block of ``size``
    documents) in one table, ``a`` null in the former. The two files go to the workers once, as a broadcast variable of their size."""
    shared = docs.sparkSession.sparkContext.broadcast((spec, model, can_be_ranked(spec)))

    def run(batches):
        from pyspark import TaskContext
        one, two = ByteLevel(shared.value[0], shared.value[2]), Pieces(shared.value[1])
        written = names(len(one.bytes), b",", b"|"), names(len(two.bytes), b",", b";")
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j in N.blocks(batch.column(1), BLOCK):
                for s in range(i, j, BLOCK_ROWS):
                    yield from block_rows(one, two, written, batch.slice(s, min(BLOCK_ROWS, j - s)), block)
                    block += 1

    def block_rows(one, two, written, part, block):
        ids, rows, texts = part.column(0), [], []
        for k, raw in enumerate(part.column(1).to_pylist()):
            if raw:
                rows.append(k)
                texts.append(raw.decode("utf-8", "replace"))
        fit, coded = [], ([], [])
        for k, text, x, y in zip(rows, texts, one.encode(texts), two.encode(texts)):
            raw = b" " + text.encode()
            x = x.tolist() if isinstance(x, np.ndarray) else x
            if b"".join([one.bytes[t] for t in x]) == raw and b"".join([two.bytes[t] for t in y]) == raw:
                fit.append(k)
                coded[0].append(x)
                coded[1].append(y)
        zero = sorted(set(range(len(part))) - set(fit))
        if zero:
            nil = [0] * len(zero)
            yield batch_of(len(zero), {"doc_id": ids.take(pa.array(zero)), "n_a": nil, "n_b": nil, "n_groups": nil, "n_links": nil, "groups_sha256": [""] * len(zero)})
        if fit:
            both, n = Aligned(Side(coded[0], one.lengths), Side(coded[1], two.lengths)), len(fit)
            yield batch_of(n, {"doc_id": ids.take(pa.array(fit)), "block": [block] * n, "place": range(n), "n_a": both.a.counts, "n_b": both.b.counts,
                               "n_groups": both.n_groups, "n_links": both.n_links, "groups_sha256": both.digests(*written)})
            a, b, n_docs, links, planes = postings(*both.pairs(), n)
            yield batch_of(len(a), {"block": np.full(len(a), block), "size": np.full(len(a), n), "a": a, "b": b, "n_docs": n_docs, "links": links, "planes": planes})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary")).mapInArrow(run, SCHEMA)


def bucketed(rows: DataFrame) -> DataFrame:
    """a, b, bucket, n_docs, links: the postings' counts added per pair and bucket of blocks."""
    return rows.groupBy("a", "b", "bucket").agg(F.sum("n_docs").alias("n_docs"), F.sum("links").alias("links"))


def pair_counts(parts: DataFrame) -> DataFrame:
    """a, b, n_docs (documents that hold the pair linked), links, best (no pair of its A id has more documents)."""
    counts = parts.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("links").alias("links"))
    top = counts.groupBy(F.col("a").alias("top_a")).agg(F.max("n_docs").alias("top"))
    return counts.join(top, F.col("a") == F.col("top_a")).select("a", "b", "n_docs", "links", (F.col("n_docs") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, spec: str, model: bytes) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) and pairs (a, b, n_docs, links, best)."""
    table = C.written(inverted(docs, spec, model), "aln-blocks")
    posted = table.filter("a is not null")
    buckets = max(1, math.isqrt(table.filter("place = 0").count()))
    posted = posted.select("block", "size", "a", "b", "n_docs", "links", "planes", F.pmod(F.xxhash64("block"), F.lit(buckets)).alias("bucket"))
    parts = C.written(bucketed(posted), "aln-parts")
    pairs = C.written(pair_counts(parts), "aln-pairs")

    at = [F.col(c).alias("p" + c) for c in ("a", "b")]
    sent = (parts.select("a", "b", "bucket").join(pairs.select(*at, F.col("n_docs").alias("count"), "best"), (F.col("a") == F.col("pa")) & (F.col("b") == F.col("pb")))
            .select("pa", "pb", F.col("bucket").alias("to"), "count", "best"))
    scored = posted.join(sent, (F.col("a") == F.col("pa")) & (F.col("b") == F.col("pb")) & (F.col("bucket") == F.col("to")))

    def collect(batches):
        at, size, total = None, 0, None
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)]])
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if j == i:
                    continue
                part = batch.slice(i, j - i)
                if blocks[i] != at:
                    if at is not None:
                        yield out(at, size, total)
                    at, size = blocks[i], part.column(1)[0].as_py()
                    total = np.zeros((2, size), np.int64)
                best = part.column(3).to_numpy(zero_copy_only=False)
                total += np.stack(weighted(part.column(4), size, best, part.column(2).to_numpy()))
        if at is not None:
            yield out(at, size, total)

    def out(block, size, total):
        return pa.RecordBatch.from_arrays([pa.array(np.full(size, block), pa.int64()), pa.array(np.arange(size), pa.int32()), pa.array(total[0]), pa.array(total[1])],
                                          names=["at_block", "at_place", "n_best", "count_sum"])

    found = (scored.select("block", "size", "count", "best", "planes").repartition("block").sortWithinPartitions("block")
             .mapInArrow(collect, "at_block long, at_place int, n_best long, count_sum long"))
    rows = table.filter("a is null").join(found, (F.col("block") == F.col("at_block")) & (F.col("place") == F.col("at_place")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256"), pairs


def query(spark: SparkSession, sf_dir: str, spec_path: str | None = None, model_path: str | None = None) -> DataFrame:
    import public_tokenizers as P
    with open(spec_path or P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    with open(model_path or P.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return alignment(C.table(spark, sf_dir, "documents"), spec, model)[0]
