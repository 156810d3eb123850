"""The stored combo: deduplicated readings of all releases so far, in a bucketed table.

A new pull is deduplicated against the store without moving what is stored. The table is bucketed and sorted by
``_key``, a hash of the five content columns (never null, so it can be a join key); the pull is shuffled into the same
buckets and anti-joined bucket by bucket, and only readings that are new, or that come from an earlier
provenance than the stored copy, are appended. Reading the store takes the earliest provenance per
reading, an aggregation inside the buckets: no shuffle either.

Adding a pull again, or after a run that stopped half-way, appends only what is missing: every row that a stored
row already stands for is left out. So the store equals one full merge of all pulls, whatever their order.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow import schema as S
from traitflow.operators import dedup as DD
from traitflow.sources import files as FS

_COLUMNS = ", ".join(f"`{c}` {S.COMBO_SCHEMA[c].dataType.simpleString()}" for c in S.READING_KEY)


def reading_hash() -> F.Column:
    return F.xxhash64(*S.READING_KEY)


def coded(pull: DataFrame, provenance_order: list[str]) -> DataFrame:
    """``_key``, content columns and ``_code`` (its earliest provenance and source as one integer) of every distinct
    reading of a pull; copies collapse before the shuffle."""
    best = pull.groupBy(*S.READING_KEY).agg(F.min(DD.survivor_code(provenance_order)).alias("_code"))
    return best.select(reading_hash().alias("_key"), *S.READING_KEY, "_code")


class ComboStore:
    """``ComboStore(spark, path, order).add(pull)`` once per pull; ``read()`` gives the merged combo.

    ``buckets`` counts when the store is made (about 256 MB of readings each suits a release); a store that exists
    keeps its own, and its provenance order: new provenances may only be added at its end."""

    def __init__(self, spark: SparkSession, path: str, provenance_order: list[str], buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        layout = FS.read_text(spark, f"{self.path}/_layout.json")
        if layout is None:
            FS.write_text(spark, f"{self.path}/_layout.json", json.dumps({"buckets": buckets, "provenances": provenance_order}))
        else:
            known = json.loads(layout)
            buckets = known["buckets"]
            if provenance_order[:len(known["provenances"])] != known["provenances"]:
                raise ValueError(f"provenance order {provenance_order} does not continue the store's {known['provenances']}")
            if provenance_order != known["provenances"]:
                FS.write_text(spark, f"{self.path}/_layout.json", json.dumps(known | {"provenances": provenance_order}))
        self.order, self.buckets = provenance_order, buckets
        self.table = "combo_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        location = self.path.replace("'", "''")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (`_key` bigint, {_COLUMNS}, `_code` int) USING parquet "
                  f"CLUSTERED BY (`_key`) SORTED BY (`_key`) INTO {buckets} BUCKETS LOCATION '{location}'")

    def rows(self) -> DataFrame:
        """What is stored: a reading has a row for each time that an earlier provenance came for it."""
        self.spark.catalog.refreshTable(self.table)     # other sessions add, too
        return self.spark.table(self.table)

    def missing(self, pull: DataFrame) -> DataFrame:
        """The readings of ``pull`` that the store lacks or has from a later provenance only."""
        new = coded(pull, self.order)
        old = self.rows().select(*[F.col(c).alias(f"old{c}") for c in ("_key", *S.READING_KEY, "_code")]).hint("merge")
        # not written as equalities: as join keys they would ask for a shuffle of the store by all of them
        same = ~F.array_contains(F.array(*[F.col(c).eqNullSafe(F.col(f"old{c}")) for c in S.READING_KEY]), F.lit(False))
        return new.join(old, (F.col("_key") == F.col("old_key")) & same & (F.col("old_code") <= F.col("_code")), "left_anti")

    def add(self, pull: DataFrame) -> None:
        self.missing(pull).write.insertInto(self.table)

    def read(self) -> DataFrame:
        """The combo: every reading once, with the provenance and source that come first."""
        best = self.rows().groupBy("_key", *S.READING_KEY).agg(F.min("_code").alias("_code"))
        return DD.named(best, self.order)

    def compacted(self, path: str) -> ComboStore:
        """The same store at ``path`` with one row per reading and one file per bucket; nothing is shuffled."""
        fresh = ComboStore(self.spark, path, self.order, self.buckets)
        best = self.rows().groupBy("_key", *S.READING_KEY).agg(F.min("_code").alias("_code"))
        best.select("_key", *S.READING_KEY, "_code").write.insertInto(fresh.table)
        return fresh

    def forget(self) -> None:
        """Take the table out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
