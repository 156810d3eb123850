"""Small files and listings through Spark's file systems (any store that Spark can reach)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name below ``path``, bytes, time of change) of every file, sorted; none if ``path`` is not there."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    root = qualified(spark, path) + "/"
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString().removeprefix(root), f.getLen(), f.getModificationTime()))
    return sorted(found)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a path or glob stands for."""
    fs, p = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old text or the new one, never half of it: written aside, then renamed."""
    fs, p = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(aside), fs.makeQualified(p), options)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
