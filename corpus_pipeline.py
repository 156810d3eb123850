"""From raw documents to a training mix: five stages, each an operator of ``traitflow.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns what the next one
reads as ``docs``. The first four return the columns of ``documents``; the last returns one row per
remaining document with its place in the mix:

1. quality_rules: documents that the base rules or the certified cutoffs reject go.
2. near_duplicates: of each group linked by Jaccard similarity of five words (0.8 or more) the smallest id stays.
3. decontamination: documents that hold a benchmark window go.
4. secrets: secrets in the texts are masked; no document goes.
5. mixing: copies and words taken of every document, sources at their target weights.

Edge cases, by stage: a document with a null or empty text fails the base rules and goes in the first stage, so the later ones see
texts only; a null id is kept and counts last among near copies; equal rows (same id and text) are one document from the second
stage on, of equal texts under different ids the smallest id stays; near copies of which each links with another are one
group, also where the ends of a chain do not link; a null source is a source of its own in the mix; a null lang is a stratum of
its own; very long texts are judged whole; tables without labels give no certified cutoffs (the base rules stay), an empty benchmark
keeps every document, and an empty table of documents gives an empty mix; further columns pass through the first four stages whatever their
names and are left out of the mix.

``run`` writes each stage to the shared checkpoint folder and reads it back, so a lost executor costs
at most the stage at hand. Labels and the benchmark are read from ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from traitflow.llm import common as C
from traitflow.llm import op2_decontamination, op4_jaccard, op6_rules, op7_mixing, op8_secrets

# Cutoffs certified by binomial bounds and a random forest have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None

# Near copies of the stage; the op4 query has its own contract (three words, 0.9).
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_rules.kept_documents(docs, C.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_jaccard.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_decontamination.clean_documents(docs, C.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_secrets.redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keep = tuple(c for c in ("lang", "n_chars") if c in docs.columns)
    return op7_mixing.mix(docs, keep=("source", *keep))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents`` in ``sf_dir``."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
