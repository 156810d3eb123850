"""Publishing a release: written aside, described by a manifest, promoted by one rename.

    release = Release(spark, "/shared/releases", run)
    release.sink("trait_summary", lambda path: write_counts(df, path))      # any number of sinks
    release.promote({})
    current(spark, "/shared/releases")                                      # the promoted version's folder and manifest

Outputs of a run go to ``<root>/versions/<run>``, which no reader looks at before it is promoted; what is
published stays as it is until then, and after it as an older version. After each sink its files are recorded (size, lines,
checksum of the lines, counted in Spark). ``promote`` writes the whole manifest and then replaces ``CURRENT``, a
small file that names the version, by renaming. ``run`` is a digest of everything that decides the outputs, so a run that
is started again takes up its own folder: sinks whose recorded files are all there are not written again, others from scratch, and
a promoted run is left alone.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from traitflow.sources import files as FS


def described(spark: SparkSession, path: str) -> list[dict]:
    """name, size, lines and checksum of every data file below ``path``. The checksum adds up 64-bit hashes of the
    lines with their number in the sum, so splits and tasks do not matter."""
    sizes = {name: size for name, size, _ in FS.listing(spark, path) if not _hidden(name)}
    if not sizes:
        return []
    lines = (spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("file"), F.xxhash64("value").alias("h"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("h").cast("decimal(38,0)")).alias("checksum")))
    root = FS.qualified(spark, path)
    found = {unquote(row["file"]).replace("file:///", "file:/").removeprefix(root + "/"): (row["lines"], str(row["checksum"]))
             for row in lines.collect()}        # one row per file that the run wrote
    return [{"name": n, "size": s, "lines": found.get(n, (0, "0"))[0], "checksum": found.get(n, (0, "0"))[1]} for n, s in sorted(sizes.items())]


def _hidden(name: str) -> bool:
    return any(part.startswith((".", "_")) for part in name.split("/"))


class Release:
    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), run
        self.path = f"{self.root}/versions/{run}"
        self.done: dict[str, list[dict]] = {}

    def complete(self) -> bool:
        """This run was promoted before, and all its files are there."""
        text = FS.read_text(self.spark, f"{self.path}/_MANIFEST.json")
        if text is None or not all(self._there(n, files) for n, files in json.loads(text)["sinks"].items()):
            return False
        self.done = json.loads(text)["sinks"]
        return True

    def recorded(self, name: str) -> bool:
        """The output ``name`` was written whole by this run."""
        text = FS.read_text(self.spark, self._record(name))
        return text is not None and self._there(name, json.loads(text))

    def _record(self, name: str) -> str:
        return f"{self.path}/_sinks/{name.replace('/', '%2F')}.json"

    def _there(self, name: str, files: list[dict]) -> bool:
        have = {n: s for n, s, _ in FS.listing(self.spark, f"{self.path}/{name}") if not _hidden(n)}
        return have == {f["name"]: f["size"] for f in files}

    def sink(self, name: str, write: Callable[[str], None]) -> str:
        """Path of the output ``name``; ``write(path)`` runs unless this run has written it whole."""
        path = f"{self.path}/{name}"
        if not self.recorded(name):
            FS.delete(self.spark, path)     # what a lost run left; never published
            write(path)
            FS.write_text(self.spark, self._record(name), json.dumps(described(self.spark, path)))
        self.done[name] = json.loads(FS.read_text(self.spark, self._record(name)))
        return path

    def promote(self, stages: dict[str, str] | None = None) -> dict[str, str]:
        """Publish this version: name -> path of its outputs and of the ``stages`` that it was made from."""
        manifest = f"{self.path}/_MANIFEST.json"
        if stages is None:
            stages = json.loads(FS.read_text(self.spark, manifest))["stages"]
        else:
            FS.write_text(self.spark, manifest, json.dumps({"run": self.run, "sinks": self.done, "stages": stages}))
        FS.write_text(self.spark, f"{self.root}/CURRENT", self.run)
        return stages | {name: f"{self.path}/{name}" for name in self.done}


def current(spark: SparkSession, root: str) -> tuple[str, dict]:
    """Folder and manifest of the promoted version."""
    run = FS.read_text(spark, f"{root.rstrip('/')}/CURRENT")
    if run is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    path = f"{root.rstrip('/')}/versions/{run.strip()}"
    return path, json.loads(FS.read_text(spark, f"{path}/_MANIFEST.json"))


def damaged(spark: SparkSession, root: str) -> list[str]:
    """Files of the published version that are missing, new or other than the manifest says; reads all of them."""
    path, manifest = current(spark, root)
    out = []
    for name, files in manifest["sinks"].items():
        was, now = ({f["name"]: f for f in x} for x in (files, described(spark, f"{path}/{name}")))
        out += [f"{name}/{f}" for f in sorted(was.keys() | now.keys()) if was.get(f) != now.get(f)]
    return out


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all versions but the promoted one and the ``keep - 1`` newest others."""
    path, _ = current(spark, root)
    changed: dict[str, int] = {}
    for name, _, at in FS.listing(spark, f"{root.rstrip('/')}/versions"):
        run = name.split("/")[0]
        changed[run] = max(changed.get(run, 0), at)
    others = sorted((r for r in changed if not path.endswith("/" + r)), key=lambda r: -changed[r])
    for run in others[max(0, keep - 1):]:
        FS.delete(spark, f"{root.rstrip('/')}/versions/{run}")
    return others[max(0, keep - 1):]
