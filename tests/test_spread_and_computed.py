"""Partitions that grow with the input, and text columns that are computed once a row."""

import pytest
from pyspark.sql import functions as F

from traitflow import session as SN
from traitflow.operators import filters as FL
from traitflow.operators import intervals as IV
from traitflow.operators import stats as ST
from traitflow.sources import lines as LN
from traitflow.sources import recipes as RC
from traitflow.sources.ingest import ingest


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def stays(spark, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.concat(F.lit("P"), F.col("id") % 40)).alias("pseudo_nhs_number"),
        F.expr("cast(date_add(date'2001-01-01', cast(id % 997 as int)) as timestamp_ntz)").alias("hospital_admission_datetime"),
        F.expr("cast(date_add(date'2001-01-01', cast(id % 997 + 1 + id % 9 as int)) as timestamp_ntz)").alias("hospital_discharge_datetime"))
    rows.write.parquet(f"{tmp_path}/stays")
    return spark.read.parquet(f"{tmp_path}/stays")


def test_partitions_grow_with_the_files_read(stays, monkeypatch):
    size = SN.input_bytes(stays)
    assert size > 0
    least = stays.sparkSession.sparkContext.defaultParallelism
    assert SN.spread(stays, "pseudo_nhs_number").rdd.getNumPartitions() == least
    assert SN.spread(stays, "pseudo_nhs_number", part_bytes=size // (3 * least)).rdd.getNumPartitions() >= 3 * least


def test_admission_windows_keep_the_number_of_partitions(stays, monkeypatch):
    """AQE merged them to as many as there are cores before, so a task's memory grew with the input."""
    want = sorted(map(str, IV.admission_windows(stays).collect()))
    n = 3 * stays.sparkSession.sparkContext.defaultParallelism
    monkeypatch.setattr(SN.spread, "__kwdefaults__", {"part_bytes": 1})
    monkeypatch.setattr(SN, "input_bytes", lambda df: n)
    many = IV.admission_windows(stays)
    assert many.rdd.getNumPartitions() == n
    assert want and sorted(map(str, many.collect())) == want


def test_a_line_is_parsed_once(spark):
    lines = spark.createDataFrame([("a\tb\tc",), ("P1\t7\t8",), ("P2\t\t9",), ("P3",), ("",)], "value string")
    out = LN.parse_lines(lines, "\t", ["a", "b", "c"]).filter((F.col("b") != "x") & F.col("a").isNotNull()).withColumn("d", F.concat("b", "c"))
    assert plan(out).count("from_csv") + plan(out).count("csvtostructs") == 1
    rows = LN.parse_lines(lines, "\t", ["a", "b", "c"]).collect()
    assert [tuple(r) for r in rows] == [("P1", "7", "8"), ("P2", None, "9"), ("P3", None, None), (None, None, None)]


def test_a_cleaned_text_is_computed_once(spark):
    df = spark.createDataFrame([("<1", "x"), ("<", "y"), (None, "z")], "result string, `other one` string")
    cleaned = FL.computed(df.withColumn("result", F.regexp_replace("result", "^<", "")), ["result"])
    assert cleaned.columns == df.columns
    used = cleaned.filter(F.col("result") != "").withColumn("n", F.col("result").cast("double") + F.length("result"))
    assert plan(used).count("regexp_replace") == 1
    assert [tuple(r) for r in used.collect()] == [("1", "x", 2.0)]
    assert [tuple(r) for r in cleaned.collect()] == [("1", "x"), ("", "y"), (None, "z")]
    assert FL.computed(df, ["not there"]) is df


def test_quotes_and_tabs_are_counted_as_before(spark):
    rows = ['a\t"b"\t\tc', '""', "", "no"]
    lines = spark.createDataFrame([(r,) for r in rows], "value string")
    assert [r.n for r in lines.select(LN.delimiter_count("\t").alias("n")).collect()] == [r.count("\t") for r in rows]
    assert [r.value for r in LN.strip_double_quotes(lines).collect()] == [r.replace('"', "") for r in rows]


def test_ingest_of_quoted_lines(spark, tmp_path):
    header = "\t".join(["PseudoNHS_2024-07-10", "ReportDate", "TestDesc", "ResultTxt", "ResultUnit"])
    body = ['P1\t2020-01-02 03:04\tHb\t"<1.5"\tg/L', "P2\t2020-01-02 03:04\tHb\t(2)\tg/L", "P3\tunknown\tHb\t3\tg/L",
            "P4\t2020-01-02 03:04\tHb\t1:32\tg/L", "P5\t2020-01-02 03:04\tHb\t5cm\t", "P1\t2020-01-02 03:04\tHb\t<1.5\tg/L"]
    (tmp_path / "x.csv").write_text("\n".join([header, *body]) + "\n")
    got = sorted((r.pseudo_nhs_number, str(r.test_date), r.result, r.result_value_units) for r in ingest(spark, RC.barts_path_2024_09(), str(tmp_path)).collect())
    assert got == [("P1", "2020-01-02", 1.5, "g/L"), ("P2", "2020-01-02", 2.0, "g/L")]


def test_rows_that_an_earlier_filter_drops_are_not_parsed(spark, tmp_path):
    """A line without a person and with a tab in its text has the right width and shifted columns: its result is dropped before
    its date is parsed strictly."""
    header = ["PseudoNHS_2023_11_08", "SystemLookup", "ClinicalSignificanceDate", "EventResult", "UnitsCode", "UnitsDesc", "NormalCode",
              "NormalDesc", "LowValue", "HighValue", "EventText", "EventType", "EventParent", "Extra"]
    good = ["P1", "sys", "Apr 1 2020  5:12AM", ">7", "u", "kg", "n", "n", "0", "9", "x", "BMI", "p", "z"]
    shifted = ["sys", "Apr 1 2020  5:12AM", "14.5-", "u", "kg", "n", "n", "0", "9", "say a", "b", "BMI", "p", "z"]
    (tmp_path / "x.csv").write_text("\n".join("\t".join(r) for r in (header, good, shifted)) + "\n")
    got = ingest(spark, RC.barts_meas_2023_12(), str(tmp_path)).collect()
    assert [(r.pseudo_nhs_number, str(r.test_date), r.result) for r in got] == [("P1", "2020-04-01", 7.0)]


def test_an_island_ends_at_the_next_change(spark):
    """Segments are not aggregated again once their label sets are known, and the running counts need one frame."""
    rows = [("P1", 1, 9, ["APC"]), ("P1", 3, 5, ["APC"]), ("P1", 5, 5, ["buffer_after"]), ("P1", 9, 12, ["buffer_after"]), ("P1", 10, 14, ["APC"]),
            ("P1", 20, None, ["APC"]), ("P2", 4, 4, ["APC"]), ("P2", 6, 2, ["APC"]), ("P2", 7, 8, ["APC"]), ("P2", 8, 9, ["APC"]), (None, 1, 2, ["APC"])]
    df = spark.createDataFrame(rows, "pseudo_nhs_number string, start_date int, end_date int, region_types array<string>")
    merged = IV.split_and_remerge_intervals(df)
    assert plan(merged).count("Aggregate") == 1
    got = sorted((r.pseudo_nhs_number, r.start_date, r.end_date, tuple(r.region_types)) for r in merged.collect())
    assert got == [("P1", 1, 9, ("APC",)), ("P1", 9, 10, ("buffer_after",)), ("P1", 10, 12, ("APC", "buffer_after")), ("P1", 12, 14, ("APC",)),
                   ("P2", 7, 9, ("APC",))]
    by_islands = IV.islands_min_max(IV.covered_segments(df))
    assert sorted(map(str, by_islands.collect())) == sorted(map(str, merged.collect()))
    assert "-1" not in plan(IV.sweep_segments(df)).split("Aggregate")[0].replace("bigint", "")


@pytest.mark.parametrize("what", ["phenotype", "covariate"])
def test_a_cohorts_readings_are_dealt_once_by_person(spark, monkeypatch, what):
    """AQE merged the pivot's partitions to as many as there are cores before, so a task's memory grew with the input."""
    df = spark.createDataFrame([("all", f"P{i % 30}", "t1" if i % 2 else "t2", float(i % 7), None if i % 11 == 0 else 20 + i / 8) for i in range(400)],
                               "setting string, pseudo_nhs_number string, trait string, value double, age_at_test double")
    ids = spark.createDataFrame([(f"P{i}", f"G{i}") for i in range(25)], "pseudo_nhs_number string, IID string")

    def wide():
        return ST.phenotype_wide(ST.phenotype_table(df, ids), ["t1", "t2"]) if what == "phenotype" else ST.covariate_megawide(df, ids)
    want = sorted(map(str, wide().collect()))
    n = 3 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(SN.spread, "__kwdefaults__", {"part_bytes": 1})
    monkeypatch.setattr(SN, "input_bytes", lambda df: n)
    many = wide()
    assert many.rdd.getNumPartitions() == n
    assert len(want) == 25 and sorted(map(str, many.collect())) == want
