"""Randomised equivalence of the string helpers with plain-Python definitions."""
import random
import re

from pyspark.sql import functions as F

from traitflow.functions import scalars as X

ALPHABET = ["<", ">", " ", "+", "-", "/", "{", "}", "(", ")", "*", "%", ".", ",", "1", "2", "5", "c", "m", "$", "\\"]


def strings(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 8))) for _ in range(n)]


def py_strip_prefixes(s, prefixes):
    for p in prefixes:
        s = s[len(p):] if s.startswith(p) else s
    return s


def py_strip_suffixes(s, suffixes):
    for p in suffixes:
        s = s[:-len(p)] if p and s.endswith(p) else s
    return s


def py_unwrap(s):
    s = re.sub(r"^\{(.*?)\}$", r"\1", s, count=1, flags=re.S)
    s = re.sub(r"^\((.*?)\)$", r"\1", s, count=1, flags=re.S)
    return re.sub(r"^\*\{(.*?)\}$", r"\1", s, count=1, flags=re.S)


def py_number(s):
    return float(s) if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", s) else None


def test_helpers_match_python(spark):
    vals = strings(3000, 5) + ["<<5", "+/-5", "5cm", "{5}", "*{5}", "(5)", "5.", ".5", "$1", "\\5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    prefixes, suffixes = ["<", ">", "+-", "+/-", " "], ["%", "cm", " -"]
    rows = df.select(
        "v",
        X.strip_prefix_chain("v", prefixes).alias("p"),
        X.strip_suffix_chain("v", suffixes).alias("s"),
        X.replace_first("v", r"[0-9]", "#").alias("r"),
        X.replace_all_literal("v", ".", "$").alias("a"),
        X.unwrap_brackets("v").alias("u"),
        X.parse_number_lenient("v").alias("n"),
        X.strip_chars("v").alias("t"),
    ).collect()
    for r in rows:
        v = r["v"]
        assert r["p"] == py_strip_prefixes(v, prefixes), v
        assert r["s"] == py_strip_suffixes(v, suffixes), v
        assert r["r"] == re.sub(r"[0-9]", "#", v, count=1), v
        assert r["a"] == v.replace(".", "$"), v
        assert r["u"] == py_unwrap(v), v
        assert r["n"] == py_number(v), v
        assert r["t"] == v.strip(" \t\n\r\f\v"), v
