import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns whose names the operators use themselves
    T.StructField("size", T.StringType()), T.StructField("row", T.StringType()), T.StructField("n", T.StringType()),
    T.StructField("_row", T.StringType()), T.StructField("_key", T.StringType()), T.StructField("gram", T.StringType()), T.StructField("cid", T.StringType())])


def prose(rng, n):
    parts = ["er", "th", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "ou"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(rng, text, k):
    w = text.split(" ")
    for _ in range(k):
        w[rng.randrange(len(w))] = "zz" + str(rng.randrange(99))
    return " ".join(w)


@pytest.fixture(scope="session")
def rows():
    """Documents with copies, near copies, shared passages, benchmark passages, secrets and every odd case."""
    rng = random.Random(5)
    out, base = [], [prose(rng, 150) for _ in range(12)]
    passage = prose(rng, 60)
    for i in range(60):
        b = base[i % 12]
        kind = i % 5
        text = [b, edited(rng, b, 1), edited(rng, b, 6), prose(rng, 80) + " " + passage + "\n" + prose(rng, 30), prose(rng, 40 + i)][kind]
        out.append((i, text))
    out += [(100, None), (101, ""), (102, " \t\n\x0b "), (103, "one"), (104, "ONE"), (105, "two words"), (106, "é" * 300), (107, "a" * 700), (108, "a " * 400),
            (109, prose(rng, 5000)), (110, "x y  z \U0001F600 é́"), (111, "\n\n" + "line here\n" * 40), (112, "0" * 99), (113, "0" * 100),
            (None, base[0]), (None, None), (None, "lonely words only"), (7, out[7][1]), (7, prose(rng, 70)), (8, out[8][1]), (114, "\r\nmixed\r\nline ends\r\n" * 20)]
    return [(d, t, ["en", "fr", None][k % 3], ["s1", "s2", "s2", None, "s0", "é"][k % 6], None if t is None else len(t), "x", "y", "z", "r", "k", "g", "c") for k, (d, t) in enumerate(out)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def plain(rows):
    """The same without null or repeated ids."""
    seen, out = set(), []
    for r in rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)
