"""Registry of written stages that outlives the application that wrote them.

A stage is a Parquet folder of its own name under ``root`` and one manifest, a small JSON file that is renamed into place after
the data are complete: key, fingerprint of the inputs, digest of the library's code, schema, rows and the files with
their sizes. A later application reads a stage only if a manifest of the
same key, fingerprint and code is there and the folder still holds exactly these files. So a changed input, changed
code, a stage whose writer was lost, or a folder that somebody touched is written anew, in a new folder; nothing that another
job may be reading is overwritten.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from traitflow.sources import files as FS


@cache
def code_digest() -> str:
    """Digest of the library's source files outside ``llm``: a stage of other code is not reused."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha256()
    for folder, subfolders, names in os.walk(root):
        subfolders[:] = sorted(s for s in subfolders if s not in ("llm", "__pycache__"))
        for name in sorted(names):
            if name.endswith(".py"):
                with open(os.path.join(folder, name), "rb") as f:
                    h.update(os.path.relpath(os.path.join(folder, name), root).encode() + b"\0" + f.read() + b"\0")
    return h.hexdigest()[:16]


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Digest of the names, sizes and modification times of the files below ``paths``, from Spark's file systems."""
    found = [f"{path}:{name}:{size}:{at}" for path in paths for name, size, at in FS.listing(spark, path)]
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


class StageRegistry:
    def __init__(self, spark: SparkSession, root: str, code: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.code = code or code_digest()

    def _folder(self, key: str) -> str:
        return f"{self.root}/{hashlib.sha256(key.encode()).hexdigest()[:24]}"

    def manifests(self, key: str) -> list[dict]:
        """Complete manifests of ``key``, newest first."""
        names = [n for n, _, _ in FS.listing(self.spark, f"{self._folder(key)}/manifests") if n.endswith(".json") and not n.startswith("_")]
        found = [json.loads(FS.read_text(self.spark, f"{self._folder(key)}/manifests/{n}")) for n in names]
        return sorted((m for m in found if m["key"] == key), key=lambda m: -m["written"])

    def find(self, key: str, inputs: str) -> dict | None:
        """Manifest of the newest stage of ``key`` made by this code from these inputs whose files are all there."""
        for m in self.manifests(key):
            if m["inputs"] == inputs and m["code"] == self.code and m["files"] == self._files(m["path"]):
                return m
        return None

    def _files(self, path: str) -> list[list]:
        return [[name, size] for name, size, _ in FS.listing(self.spark, path)]

    def open(self, manifest: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(manifest["schema"])).parquet(manifest["path"])

    def write(self, key: str, inputs: str, df: DataFrame, partition_by: list[str] | None = None) -> dict:
        """Write a stage and then its manifest."""
        name = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:12]}"
        path = f"{self._folder(key)}/data-{name}"
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        schema = _stored(df, partition_by)
        rows = self.spark.read.schema(schema).parquet(path).count()     # from the files' footers
        manifest = {"key": key, "inputs": inputs, "code": self.code, "path": path, "schema": json.loads(schema.json()),
                    "rows": rows, "files": self._files(path), "written": time.time()}
        FS.write_text(self.spark, f"{self._folder(key)}/manifests/{name}.json", json.dumps(manifest))
        return manifest

    def stage(self, key: str, inputs: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> DataFrame:
        """The stage ``key``: read if this code has written it from these inputs, else built, written and read."""
        return self.open(self.find(key, inputs) or self.write(key, inputs, build(), partition_by))

    def prune(self, key: str) -> int:
        """Delete every folder of ``key`` but that of its newest complete stage; for times when no job reads them."""
        kept = next((m for m in self.manifests(key) if m["files"] == self._files(m["path"])), None)
        gone = 0
        for part in {n.split("/")[0] for n, _, _ in FS.listing(self.spark, self._folder(key))} - {"manifests"}:
            if kept is None or not kept["path"].endswith("/" + part):
                FS.delete(self.spark, f"{self._folder(key)}/{part}")
                FS.delete(self.spark, f"{self._folder(key)}/manifests/{part.removeprefix('data-')}.json")
                gone += 1
        return gone


def _stored(df: DataFrame, partition_by: list[str] | None) -> T.StructType:
    """Schema as Parquet gives it back: partition columns last, everything nullable."""
    last = partition_by or []
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in
                         [f for f in df.schema.fields if f.name not in last] + [df.schema[c] for c in last]])
