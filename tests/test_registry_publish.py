"""Stages that outlive their application, and releases that are published whole or not at all."""
import glob
import os
import subprocess
import sys
import textwrap
import uuid

import pytest
from pyspark.sql import functions as F

from traitflow.plans import staging
from traitflow.plans.registry import StageRegistry, fingerprint
from traitflow.session import staging_path
from traitflow.sources import publish as PU
from traitflow.sources import sinks as SK

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def numbers(spark, n=50):
    return spark.range(n).select("id", (F.col("id") % 3).alias("k"), F.concat(F.lit("line "), F.col("id").cast("string")).alias("v"))


def test_stage_is_reused_until_something_changes(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return numbers(spark)
    root, source = f"{tmp_path}/stages", f"{tmp_path}/input"
    spark.range(4).write.parquet(source)
    inputs = fingerprint(spark, source)
    one = StageRegistry(spark, root)
    assert one.stage("s", inputs, build, partition_by=["k"]).count() == 50
    again = StageRegistry(spark, root)
    back = again.stage("s", inputs, build, partition_by=["k"])
    assert len(built) == 1 and sorted(back.columns) == ["id", "k", "v"] and back.filter("k = 1").count() == 17
    manifest = again.find("s", inputs)
    assert manifest["rows"] == 50 and manifest["inputs"] == inputs

    spark.range(5).write.mode("overwrite").parquet(source)                     # a changed input
    assert fingerprint(spark, source) != inputs
    again.stage("s", fingerprint(spark, source), build)
    assert len(built) == 2
    assert StageRegistry(spark, root, code="other").find("s", inputs) is None   # changed code
    os.remove(glob.glob(f"{manifest['path']}/k=1/*.parquet")[0])                # a lost file
    assert again.find("s", inputs) is None


def test_half_written_stage_is_not_read(spark, tmp_path):
    stages = StageRegistry(spark, f"{tmp_path}/stages")

    def breaks():
        return numbers(spark).withColumn("x", F.when(F.col("id") == 49, F.raise_error(F.lit("lost"))).otherwise(F.lit(1)))
    with pytest.raises(Exception, match="lost"):
        stages.stage("s", "i", breaks)
    assert stages.find("s", "i") is None and stages.manifests("s") == []
    assert stages.stage("s", "i", lambda: numbers(spark, 7)).count() == 7
    stages.write("s", "i", numbers(spark, 8))
    assert stages.prune("s") >= 1 and stages.open(stages.find("s", "i")).count() == 8
    assert stages.stage("empty", "i", lambda: numbers(spark).filter("id < 0")).count() == 0


def test_a_second_application_reuses_the_stage(tmp_path):
    """Two drivers, one after the other, with the same checkpoint folder; the second is not allowed to build."""
    code = textwrap.dedent("""
        import sys
        sys.path.insert(0, %r)
        from traitflow.session import get_spark
        from traitflow.plans.staging import staged
        spark = get_spark("local[2]", 2, extra_conf={"spark.checkpoint.dir": %r, "spark.ui.enabled": "false"})
        def build():
            if sys.argv[1] == "second":
                raise SystemExit("built again")
            return spark.range(11)
        print("rows", staged(spark, "kept", build, sys.argv[2]).count(), spark.sparkContext.applicationId)
    """) % (ROOT, str(tmp_path))
    run = lambda *a: subprocess.run([sys.executable, "-c", code, *a], capture_output=True, text=True, timeout=300)
    first, second, changed = run("first", "in1"), run("second", "in1"), run("second", "in2")
    assert "rows 11" in first.stdout, first.stderr[-2000:]
    assert "rows 11" in second.stdout and first.stdout != second.stdout, second.stderr[-2000:]
    assert "built again" in changed.stderr


def test_forgotten_stages_are_built_again(spark):
    built = []

    def build():
        built.append(1)
        return spark.range(3)
    key = f"forgettable-{uuid.uuid4()}"
    staging.staged(spark, key, build, "i")
    staging._STAGED.clear()
    staging.staged(spark, key, build, "i")
    assert len(built) == 1
    staging.forget()
    try:
        staging.staged(spark, key, build, "i")
        assert len(built) == 2
    finally:
        staging._fresh_only = False


def outputs(spark, release, calls, fail=False):
    def first(path):
        calls.append("first")
        SK.write_tsv(numbers(spark), path, "NA", partition_by=["k"])

    def second(path):
        calls.append("second")
        if fail:
            numbers(spark, 5).write.parquet(path)      # half of it
            raise RuntimeError("driver lost")
        numbers(spark).write.mode("overwrite").parquet(path)
    release.sink("a/first", first)
    release.sink("b second", second)
    return release.promote({"stage": "somewhere"})


def test_a_release_lost_between_two_sinks(spark):
    root = staging_path(spark, "publish")
    old = PU.Release(spark, root, "run0")
    calls = []
    outputs(spark, old, calls)
    was, manifest = PU.current(spark, root)
    assert was.endswith("versions/run0") and {f["lines"] for f in manifest["sinks"]["a/first"]} and PU.damaged(spark, root) == []

    with pytest.raises(RuntimeError, match="driver lost"):
        outputs(spark, PU.Release(spark, root, "run1"), calls, fail=True)
    assert PU.current(spark, root)[0] == was and spark.read.parquet(f"{was}/b second").count() == 50   # the old release stands
    assert PU.damaged(spark, root) == []

    calls.clear()
    again = PU.Release(spark, root, "run1")
    assert not again.complete()
    paths = outputs(spark, again, calls)
    assert calls == ["second"]                                                          # the first sink was complete
    assert spark.read.parquet(paths["b second"]).count() == 50 and paths["stage"] == "somewhere"
    assert PU.current(spark, root)[0].endswith("versions/run1") and PU.damaged(spark, root) == []
    now = {n: {(f["lines"], f["checksum"]) for f in fs} for n, fs in PU.current(spark, root)[1]["sinks"].items()}
    assert now["a/first"] == {(f["lines"], f["checksum"]) for f in manifest["sinks"]["a/first"]}
    calls.clear()
    assert PU.Release(spark, root, "run1").complete() and calls == []

    part = sorted(glob.glob(f"{paths['a/first']}/k=0/part-*"))[0]
    text = open(part).read()
    os.remove(f"{os.path.dirname(part)}/.{os.path.basename(part)}.crc")     # the local file system's own guard
    open(part, "w").write(text.replace("line 3", "line 4", 1))
    assert [d.split("/")[-1] for d in PU.damaged(spark, root)] == [os.path.basename(part)]
    assert PU.drop_old_versions(spark, root, keep=1) == ["run0"] and not os.path.exists(was)


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        PU.current(spark, str(tmp_path))
