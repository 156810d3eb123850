"""Rules that hold whatever the size: no size switches, no caps, no silent column swaps."""

import datetime

import pytest
from pyspark.sql import functions as F

from traitflow.functions import scalars as X
from traitflow.operators import intervals as IV
from traitflow.operators import people as PE
from traitflow.operators import regions as RG
from traitflow.operators import stats as ST
from traitflow.operators import traits as TR
from traitflow.plans import bindings as B
from traitflow.plans import staging
from traitflow.sources import ingest as IN
from traitflow.sources import lines as LN
from traitflow.sources import readers as RD

SF = "/root/testdata/sf0.001"
DAY = datetime.date(2020, 1, 1)


def test_many_overlapping_intervals_and_null_ids(spark):
    """Label counts have no upper bound, and rows without an id make no segments."""
    rows = [("p", DAY, DAY + datetime.timedelta(5 + i), ["APC"]) for i in range(9)]
    rows += [(None, DAY, DAY + datetime.timedelta(3), ["APC"])] * 50 + [("p", DAY + datetime.timedelta(2), DAY + datetime.timedelta(4), ["buffer_after"])] * 7
    df = spark.createDataFrame(rows, "pseudo_nhs_number string, start_date date, end_date date, region_types array<string>")
    got = {(r.pseudo_nhs_number, (r.start_date - DAY).days, (r.end_date - DAY).days, tuple(r.region_types)) for r in IV.split_and_remerge_intervals(df).collect()}
    assert got == {("p", 0, 2, ("APC",)), ("p", 2, 4, ("APC", "buffer_after")), ("p", 4, 13, ("APC",))}


def test_building_operators_starts_no_job(spark):
    readings, linkage, quest = B.readings(spark, SF), B.linkage(spark, SF), B.questionnaire(spark, SF)
    stays, dicts = B.stays(spark, SF), TR.trait_dictionary(B.traits(spark), B.aliases(spark))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job expected")
    x = TR.harmonise_units(TR.join_terms_to_traits(readings, dicts), B.units(spark))
    demo = PE.valid_demographics(linkage, PE.questionnaire_demographics(quest))
    x = PE.join_demographics(PE.join_valid_people_semi(x, PE.valid_pseudo_nhs_numbers(linkage)), demo)
    RG.add_region_types(x, IV.admission_windows(stays))
    y = x.select(F.lit("all").alias("setting"), "trait", F.col("final").alias("value"), F.col("test_date").alias("date"), "pseudo_nhs_number",
                 F.col("range_position").alias("minmax_outlier"), F.lit("u").alias("unit"), "gender", "age_at_test")
    ids = PE.genotype_ids(linkage, "gsa")
    ST.per_individual_stats(y)
    ST.trait_study_summary(y)
    ST.trait_log10_histogram(y)
    ST.phenotype_table(y, ids)
    ST.covariate_long(y, ids)
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("", "")


def test_files_with_swapped_columns_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,term,val\n1,HbA1c,5\n")
    (tmp_path / "b.csv").write_text("id,val,term\n2,7,HbA1c\n")
    with pytest.raises(Exception, match="header|Header"):
        RD.read_raw(spark, str(tmp_path)).collect()
    (tmp_path / "b.csv").write_text("id,term,val\n2,HbA1c,7\n")
    assert {tuple(r) for r in RD.read_raw(spark, str(tmp_path)).collect()} == {("1", "HbA1c", "5"), ("2", "HbA1c", "7")}


def test_lines_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,term,val\n1,HbA1c,5\n")
    (tmp_path / "b.csv").write_text("id,val,term\n2,7,HbA1c\n")
    recipe = IN.Recipe(key="k", line_rules=[("strip_quotes",)], rename={"id": "pseudo_nhs_number", "term": "original_term", "val": "result"})
    with pytest.raises(Exception, match="different headers"):
        IN.read_source(spark, recipe, str(tmp_path)).collect()


def test_step_counts_and_quarantine(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,date,term,val,unit\n1,2020-01-01,T,5,u\n2,2020-01-01,T,abc,u\n3,2020-01-01,"T, x",5,u\n')
    recipe = IN.Recipe(key="k", line_rules=[("drop_quoted", ",")], rename={"id": "pseudo_nhs_number", "date": "test_date", "term": "original_term", "val": "result", "unit": "result_value_units"},
                       steps=[("regex_block", "result", ["[a-z]"])])
    log = IN.StepCounts()
    assert [r.pseudo_nhs_number for r in IN.ingest(spark, recipe, str(tmp_path), counts=log).collect()] == ["1"]
    assert log.rows("k") == [("k", 1, "regex_block result", 2, 1, -50.0)]
    assert [r.value for r in IN.quarantine_lines(spark, recipe, str(tmp_path)).collect()] == ['3,2020-01-01,"T, x",5,u']


def test_replace_first_alternatives(spark):
    df = spark.createDataFrame([("xbyb",), ("a\nb",), ("zz",)], "s string")
    assert [r[0] for r in df.select(X.replace_first("s", "a|b", "#")).collect()] == ["x#yb", "#\nb", "zz"]
    assert [r[0] for r in df.select(X.replace_first("s", "(b)(.)?", "<$1>")).collect()] == ["x<b>b", "a\n<b>", "zz"]


def test_stage_follows_its_input(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    before = staging.fingerprint(spark, path)
    assert staging.fingerprint(spark, path) == before
    spark.range(4).write.mode("overwrite").parquet(path)
    assert staging.fingerprint(spark, path) != before


def test_line_halves(spark):
    df = spark.createDataFrame([('a,"b,c",d',), ("a,b,c",)], "value string")
    kept, bad = LN.drop_quoted_delimiter_lines(df, ",")
    assert kept.count() == bad.count() == 1


def test_staging_is_cleared(spark):
    import os

    from traitflow.session import clear_staging, staging_path
    before = staging_path(spark, "kept")
    spark.range(2).write.parquet(before)
    clear_staging(spark)
    assert not os.path.exists(before.removeprefix("file://"))
    staging._STAGED.clear()
