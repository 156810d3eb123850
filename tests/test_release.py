"""A whole release from raw extract files (derived from the smallest driver tables)."""
import os

import pytest
from pyspark.sql import functions as F

from traitflow.plans import bindings as B
from traitflow.plans import extracts as EX
from traitflow.plans.release import ReleaseConfig, run_release
from traitflow.session import staging_path
from traitflow.sources import recipes as RC

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_release_end_to_end(spark):
    dicts = EX.dictionaries(spark)
    quest = EX.write_text_table(B.questionnaire(spark, SF), spark, "extract-questionnaire", ",")
    cfg = ReleaseConfig(
        sources=[(RC.primary_care("2024_12_Discovery_path"), EX.primary_care(spark, SF)),
                 (RC.bradford_path_2023_05(), EX.bradford_path(spark, SF)),
                 (RC.nda_bp(), EX.nda_bp(spark, SF))],
        stays=[(EX.hes(spark, SF), "|"), (EX.hes(spark, SF), "|")],
        traits=dicts["traits"], aliases=dicts["aliases"], units=dicts["units"],
        linkage=EX.linkage(spark, SF), questionnaire=quest, as_of=B.AS_OF,
        output=staging_path(spark, "release"),
        provenance_order=RC.PROVENANCE_ORDER)
    paths = run_release(spark, cfg)
    combo = spark.read.parquet(paths["combo"])
    assert combo.select("provenance").distinct().count() == 3
    tiled = spark.read.parquet(paths["tiled"])
    assert tiled.count() > 0
    readings = spark.read.option("header", True).csv(paths["individual_trait_files/readings"])
    counts = {r[0]: r[1] for r in readings.groupBy("setting").count().collect()}
    assert counts["all"] == tiled.count() == counts["in_hospital"] + counts.get("out_hospital", 0)
    cov = spark.read.option("sep", "\t").option("header", True).csv(paths["covariates/gsa"])
    assert "AgeAtTest.Alpha.min" in cov.columns and cov.filter(F.col("setting") == "all").count() > 0
    pheno = spark.read.option("sep", "\t").option("header", True).csv(paths["phenotypes/exome"] + "/trait=HbA1c")
    assert set(pheno.columns) == {"FID", "IID", "HbA1c.median", "HbA1c.min", "HbA1c.max", "setting"} and pheno.count() > 0
    wide = spark.read.option("sep", "\t").option("header", True).csv(paths["phenotypes_wide/gsa"])
    assert {"FID", "IID", "Alpha.median", "HbA1c.max", "Rho.min"} <= set(wide.columns)
    audit = spark.read.parquet(f"{paths['logs/ingest_audit']}/parquet")
    assert audit.filter("provenance = '2023_05_Bradford_path' and after < before").count() > 0
    assert audit.select("provenance").distinct().count() == 3
