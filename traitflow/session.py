"""Spark session and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC (day arithmetic on timestamps), AQE with skew-join
# splitting (hot persons), and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def sizing_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle partitions and file split size from the input volume and the cores available.

    About two scan splits per core for small inputs, capped at 128 MB per split for large
    ones; shuffle partitions so that each holds about ``target_partition_bytes`` of input
    (never fewer than two per core). AQE coalesces what turns out smaller."""
    split = min(max(input_bytes // (2 * cores), 4 << 20), 128 << 20)
    shuffle = max(2 * cores, input_bytes // target_partition_bytes)
    # Smallest partition AQE may coalesce to: small enough that CPU-heavy stages (windows,
    # regex filters) on small inputs still use every core; 1 MB (Spark's default) at scale.
    min_part = min(max(input_bytes // (64 * cores), 64 << 10), 1 << 20)
    return {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.shuffle.partitions": str(shuffle),
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(min_part)}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "traitflow", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


PART_BYTES = 2 << 20     # input files' bytes behind one partition of ``spread``


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads (0 if it reads none)."""
    spark = df.sparkSession
    conf, total = spark._jsc.hadoopConfiguration(), 0
    for name in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def spread(df: DataFrame, *keys: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """``df`` dealt by ``keys`` to a number of partitions that grows with its input.

    AQE merges shuffle partitions until there are about as many as cores, so what one task sorts and
    aggregates would grow with the input; a number given here is kept."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // part_bytes))
    return df.repartition(n, *keys)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint folder already set on the
    context). Only a single-JVM ``local[...]`` session without either gets a local folder of its
    own; on any other master a machine-local folder would be invisible to other executors, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="traitflow-checkpoints-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/traitflow/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path for a written stage, in this application's folder under the shared checkpoint root."""
    suffix = f"-{uuid.uuid4().hex[:12]}" if unique else ""
    return f"{_application_folder(spark)}/{name}{suffix}"


def clear_staging(spark: SparkSession) -> None:
    """Delete what this application has staged. For the end of a job: results that are still lazy
    and read a stage cannot be computed afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
