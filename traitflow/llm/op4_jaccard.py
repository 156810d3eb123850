"""N-gram Jaccard join: documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more.

Order. Shingles are ordered rare-first by their document frequency over all documents, taken from a
counting sketch of fixed size (2^20 counters, merged in Spark; ties by hash). Any fixed order gives
the same links; the sketch only decides how selective the prefixes are.

Prefix filter. Documents with equal sets form a class, and only one member goes on. A class of n
shingles is joined on its first ``n - ceil(0.9 n) + 1`` shingles: linked classes share one of them.

Candidates, each pair verified at most once a round, on whole sets:

* Hubs: in each prefix shingle's group every class is paired with one hub, the class with most
  copies, so a group of m near copies makes m pairs, not m^2 / 2. Where many classes of a group stay without a link, one of
  these is the next hub, which meets the whole group, for two more rounds. Links contract classes into components.
* Rest: groups that still hold two components or more are joined with themselves for pairs between
  different components only, under the length filter, the positional filter (what can still follow
  the common shingle) and the suffix filter: the parities of a set's hashes in 1,024 cells; two sets differ in at
  least as many shingles as cells, so near copies that fall short of the limit are mostly rejected in the join and never
  written. Pairs inside a component cannot change it.

A pair whose hashed sets are similar enough is compared once more on the words themselves.
So components are exact. Results are one row per document (class, number of shingles, component);
links inside a component are not all listed.

Edge cases: null, empty and blank texts have no shingles and are components of their own; texts of
one or two words are one shingle; a null id is reported and counts last in a component; repeated rows
share a class; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C
from traitflow.llm import graph
from traitflow.llm import textnum as N

WORDS = 3
PERCENT = 90
SKETCH_BITS = 20        # counters of the document-frequency sketch: 2 ** 20, whatever the input
CHUNK = 4096
CELLS = 1024            # parities of the suffix filter
ROUNDS = 3              # of hubs, before the rest is joined
MANY = 16               # classes of a group without a link that make another round worth while; fewer go to the rest
FILTER_BITS = 26        # bits of the id filter: 2 ** 26 (8 MB), whatever the input
BLOCK = 1 << 20         # bytes of text hashed together


def shingle_sets(texts: pa.Array, words: int):
    """Yields the sorted distinct shingle hashes of each row."""
    for i, j in N.blocks(texts, BLOCK):
        raw, offsets = N.concatenated(texts.slice(i, j - i))
        h, counts = N.word_hashes(raw, offsets)
        grams = N.gram_hashes(h, words)
        start = 0
        for c in counts:
            if c >= words:
                yield np.unique(grams[start:start + c - words + 1])
            elif c:
                yield N.gram_hashes(h[start:start + c], int(c))
            else:
                yield np.zeros(0, np.uint64)
            start += c


def frequency_ranks(docs: DataFrame, words: int) -> np.ndarray:
    """Document frequencies on a log scale (one byte per counter), from a sketch over all documents.
    Only the fixed-size sketch reaches the driver."""
    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            sets = list(shingle_sets(batch.column(0), words))
            if sets:
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        yield from chunks(dict(enumerate(total.reshape(-1, CHUNK))))

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(v, dtype=np.int64)
        yield from chunks(sums)

    def chunks(by_chunk):
        live = {k: v for k, v in by_chunk.items() if v.any()}
        yield pa.RecordBatch.from_arrays([pa.array(list(live), pa.int32()), pa.array([v.tobytes() for v in live.values()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    summed = docs.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for row in summed.toLocalIterator():
        total[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] = np.frombuffer(bytes(row["counts"]), dtype=np.int64)
    return np.minimum(255, 4 * np.log2(1 + total)).astype(np.uint8)


def parities(s: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes in each cell, as 64-bit words."""
    odd = np.bincount((s >> np.uint64(65 - CELLS.bit_length())).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def profiles(docs: DataFrame, ranks: np.ndarray, words: int, percent: int) -> DataFrame:
    """doc_id, h (hash of the text), n, sig (identity of the set), prefix (its first shingles in rare-first order), cells."""
    def profile(batches):
        for batch in batches:
            ns, sigs, prefix, cells = [], [], [], []
            for s in shingle_sets(batch.column(1), words):
                n = len(s)
                ns.append(n)
                if not n:
                    sigs.append(None)
                    prefix.append(np.zeros(0, np.int64))
                    cells.append(np.zeros(0, np.int64))
                    continue
                sigs.append(signature(s))
                keep = n - (percent * n + 99) // 100 + 1
                rank = ranks[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                prefix.append(s[np.argsort(rank, kind="stable")[:keep]].view(np.int64))   # s is sorted: ties by hash
                cells.append(parities(s))
            if ns:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ns, pa.int32()), pa.array(sigs, pa.binary()), lists(prefix, pa.int64()), lists(cells, pa.int64())],
                                                 names=["doc_id", "h", "n", "sig", "prefix", "cells"])

    def lists(arrays, kind):
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(a) for a in arrays]), pa.int32()), pa.array(np.concatenate(arrays), kind))

    return docs.select("doc_id", "text", C.row_key()["h"].alias("h")).mapInArrow(profile, "doc_id long, h long, n int, sig binary, prefix array<bigint>, cells array<bigint>")


def shared_pairs_bound(a: str, b: str, percent: int) -> Column:
    """Length filter and suffix filter as a join condition over the columns n and cells of two sides."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    least, most = F.least(na, nb), F.greatest(na, nb)
    apart = F.aggregate(F.zip_with(f"{a}cells", f"{b}cells", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    # similar means 100 inter >= percent (na + nb - inter); the symmetric difference is na + nb - 2 inter
    return (100 * least >= percent * most) & ((100 + percent) * apart <= (100 - percent) * (na + nb))


def plain_set(text: str, words: int) -> set[bytes]:
    """The shingles of a text as bytes; a text of fewer words is one."""
    w = (text or "").encode().translate(N.LOWER_TABLE).split()      # at [\x20\x09-\x0D]+
    return {b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. ``texts``: cid, text."""
    def enough(both, nx, ny):
        return 100 * both >= percent * (nx + ny - both)

    def check(batches):
        for batch in batches:
            left, right = shingle_sets(batch.column(2), words), shingle_sets(batch.column(3), words)
            keep = []
            for i, (x, y) in enumerate(zip(left, right)):
                near = enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))
                if near:
                    x, y = plain_set(batch.column(2)[i].as_py(), words), plain_set(batch.column(3)[i].as_py(), words)
                    near = enough(len(x & y), len(x), len(y))
                keep.append(near)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("cid").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("cid").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def similar(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, class_id (number of the class of equal sets), group_id (number of the
    component), component_id (its smallest doc_id) for every row of ``docs``; without shingles class and
    group are null and the component is the document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    one = C.written(profiles(docs, frequency_ranks(docs, words), words, percent), "jac-profiles")
    classes = C.written(one.filter("n > 0").groupBy("sig").agg(
        F.min("doc_id").alias("doc"), F.min(F.struct("doc_id", "h")).alias("row"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("cells").alias("cells"))
        .withColumn("cid", F.monotonically_increasing_id()), "jac-classes")
    rows = classes.select("cid", "copies", "n", F.posexplode("prefix").alias("pos", "gram"))
    several = rows.groupBy(F.col("gram").alias("g")).agg(F.count(F.lit(1)).alias("many")).filter("many > 1").select("g")
    shared = C.written(rows.join(several, F.col("gram") == F.col("g"), "left_semi").select("gram", "cid", "copies", "n", "pos"), "jac-shared")

    bare = classes.select("cid", "n", "cells")
    side = lambda name: bare.select(F.col("cid").alias(name), F.col("n").alias(f"{name}n"), F.col("cells").alias(f"{name}cells"))
    tried, links, past, lone = None, None, None, shared
    for k in range(ROUNDS):
        hubs = lone.groupBy(F.col("gram").alias("g")).agg(F.max(F.struct("copies", F.negative("cid").alias("hub"))).alias("top"), F.count(F.lit(1)).alias("many"))
        hubs = hubs.filter(F.col("many") >= (MANY if k else 1)).select("g", F.negative("top.hub").alias("hub"))
        if k:
            hubs = C.written(hubs, "jac-hubs")
            if hubs.isEmpty():
                break
        stars = (shared.join(hubs, F.col("gram") == F.col("g")).filter("cid <> hub")
                 .select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct())
        stars = stars.join(side("a"), "a").join(side("b"), "b").filter(shared_pairs_bound("a", "b", percent)).select("a", "b")
        stars = C.written(stars if tried is None else stars.join(tried, ["a", "b"], "left_anti"), "jac-stars")
        found = C.written(verified(stars, class_texts(docs, classes, stars), words, percent), "jac-links")
        tried, links = (stars, found) if tried is None else (tried.unionByName(stars), links.unionByName(found))
        if k + 1 < ROUNDS:      # hubs of the next round: classes without a link that were none
            past = hubs.select(F.col("hub").alias("u")) if past is None else past.union(hubs.select("hub"))
            used = past.union(links.select("a")).union(links.select("b")).distinct()
            lone = shared.join(used, F.col("cid") == F.col("u"), "left_anti")
    labels = C.written(graph.components(links), "jac-labels")

    member = shared.join(labels, F.col("cid") == F.col("node"), "left").select("gram", "cid", "pos", F.coalesce("comp", "cid").alias("comp"))
    mixed = member.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select(F.col("gram").alias("g"))
    open_rows = C.written(member.join(mixed, F.col("gram") == F.col("g"), "left_semi").join(bare, "cid"), "jac-open")
    x = open_rows.select([F.col(c).alias("a" if c == "cid" else "a" + c) for c in open_rows.columns])
    y = open_rows.select([F.col(c).alias("b" if c == "cid" else "b" + c) for c in open_rows.columns])
    most = F.least("apos", "bpos") + 1 + F.least(F.col("an") - F.col("apos") - 1, F.col("bn") - F.col("bpos") - 1)
    positional = (100 + percent) * most >= percent * (F.col("an") + F.col("bn"))
    rest = (x.join(y, (F.col("agram") == F.col("bgram")) & (F.col("a") < F.col("b")) & (F.col("acomp") != F.col("bcomp"))
                   & positional & shared_pairs_bound("a", "b", percent)).select("a", "b").distinct())
    rest = C.written(rest.join(tried, ["a", "b"], "left_anti"), "jac-rest")
    more = C.written(verified(rest, class_texts(docs, classes, rest), words, percent), "jac-links")
    if not more.isEmpty():      # else the labels stand
        labels = C.written(graph.components(links.unionByName(more)), "jac-labels")

    named = classes.select("cid", "doc", "sig").join(labels, F.col("cid") == F.col("node"), "left").select("cid", "doc", "sig", F.coalesce("comp", "cid").alias("comp"))
    least = named.groupBy(F.col("comp").alias("c")).agg(F.min("doc").alias("component_id"))
    named = named.join(least, F.col("comp") == F.col("c")).select(F.col("sig").alias("s"), F.col("cid").alias("class_id"), F.col("comp").alias("group_id"), "component_id")
    return (one.select("doc_id", "h", F.col("n").cast("long").alias("n_shingles"), "sig").join(named, F.col("sig") == F.col("s"), "left")
            .select("doc_id", "h", "n_shingles", "class_id", "group_id", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def id_hash(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << FILTER_BITS)) + 1


def class_texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """cid, text: one text of each class of ``pairs``. A bit filter of fixed size over the ids of the classes' documents drops most
    other documents where they are read; the join by id and hash of the text then decides."""
    members = pairs.select(F.col("a").alias("m")).union(pairs.select("b")).distinct()
    wanted = C.written(classes.join(members, F.col("cid") == F.col("m"), "left_semi").select("cid", "row.doc_id", "row.h"), "jac-wanted")
    place = id_hash(F.col("doc_id"))
    maps = wanted.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in maps.toLocalIterator():      # 2 ** FILTER_BITS bits in all, whatever the input
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        bits[(row["k"] - 1) * len(part):row["k"] * len(part)] = part

    def near(batches):
        for batch in batches:
            at = batch.column(3).to_numpy() - 1
            yield batch.select([0, 1, 2]).filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))

    some = docs.select("doc_id", C.row_key()["h"].alias("h"), "text", id_hash(F.col("doc_id")).alias("at")).mapInArrow(near, "id long, th long, text string")
    found = some.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("th") == F.col("h"))).select("cid", "text")
    return C.written(found.dropDuplicates(["cid"]), "jac-texts")


def signature(s: np.ndarray) -> bytes:
    n = len(s)
    return np.array([np.sum(N.mix(s + np.uint64(n))), np.bitwise_xor.reduce(N.mix(s * np.uint64(N.STEPS[9])))], dtype=np.uint64).tobytes()


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of linked documents, with its columns: the one with the smallest id (null ids
    last, then the smaller hash of the text; of rows equal in both, one). Documents without shingles stay."""
    rows = similar(docs, words, percent)
    first = rows.filter("group_id is not null").groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "h")).alias("m"))
    keep = first.select(F.struct("m.id", "m.h").alias("_keep")).unionByName(
        rows.filter("group_id is null").select(F.struct(F.col("doc_id").alias("id"), "h").alias("_keep")).distinct())
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), C.row_key().alias("_key"))
    left = keyed.join(C.written(keep, "jac-keep"), F.col("_key").eqNullSafe(F.col("_keep")), "left_semi")
    empty = F.length(F.translate(F.coalesce("_row.text", F.lit("")), C.WORD_SPACE, "")) == 0
    return left.filter(~empty).dropDuplicates(["_key"]).unionByName(left.filter(empty)).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(C.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
link AS (SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id
         JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
         WHERE 100 * least(nx.n, ny.n) >= 90 * greatest(nx.n, ny.n)
         GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 90 * (nx.n + ny.n - count(*))),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY 1) r USING (doc_id)
"""
