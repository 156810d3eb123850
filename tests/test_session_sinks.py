import os
import uuid

from traitflow.plans.staging import staged
from traitflow.session import checkpoint_root, sizing_conf, staging_path
from traitflow.sources import sinks as SK


def test_sizing_conf_bounds():
    small = sizing_conf(10 << 20, 8)
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 4 << 20
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    big = sizing_conf(100 << 40, 8000)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 128 << 20
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(big["spark.sql.adaptive.coalescePartitions.minPartitionSize"]) == 1 << 20


def test_checkpoint_root_and_staging(spark):
    root = checkpoint_root(spark)
    assert root and staging_path(spark, "x").startswith(root)
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    key = f"test-stage-{uuid.uuid4()}"
    a = staged(spark, key, build)
    b = staged(spark, key, build)
    assert a.count() == b.count() == 5 and len(calls) == 1      # written once


def test_write_by_trait_and_tsv(spark):
    df = spark.createDataFrame([("all", "A", "p1", 1.0), ("all", "B", "p2", None), ("in_hospital", "A", "p3", 3.0)],
                               "setting string, trait string, person string, value double")
    p = staging_path(spark, "sink-test")
    SK.write_by_trait(df, p)
    back = spark.read.option("header", True).schema("person string, value double, setting string, trait string").csv(p)
    got = sorted((r["setting"], r["trait"], r["value"] if r["value"] is not None else -1.0) for r in back.collect())
    assert got == [("all", "A", 1.0), ("all", "B", -1.0), ("in_hospital", "A", 3.0)]
    assert os.path.isdir(p.replace("file:", "") + "/setting=all/trait=A")
    t = staging_path(spark, "tsv-test")
    SK.write_tsv(df, t, "NA")
    text = "".join(open(os.path.join(t, f)).read() for f in os.listdir(t) if f.startswith("part-"))
    assert "NA" in text and "\t" in text
