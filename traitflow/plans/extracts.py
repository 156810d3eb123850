"""Raw extracts in the layouts of the real sources, derived from the driver tables by Spark
and written under the shared checkpoint folder (one fresh folder per call).

They let every source recipe, reader, line rule and sink run end to end on data that grows
with the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.plans import bindings as B
from traitflow.session import staging_path


def write_text_table(df: DataFrame, spark: SparkSession, name: str, sep: str, null_token: str = "",
                     header: bool = True) -> str:
    path = staging_path(spark, name)
    (df.write.mode("overwrite").option("sep", sep).option("header", header)
     .option("nullValue", null_token).option("emptyValue", "").option("quote", '"').option("escape", '"')
     .csv(path))
    return path


def write_lines(spark: SparkSession, lines: DataFrame, name: str, header: str) -> str:
    """Raw text lines (header first in its own part) for layouts the CSV writer cannot
    produce, such as unterminated quotes."""
    path = staging_path(spark, name)
    head = spark.createDataFrame([(header,)], "value string")
    head.unionByName(lines.select("value")).write.mode("overwrite").text(path)
    return path


def _q():
    return F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit("."),
                    F.col("l_linenumber").cast("string"))


def _lines(spark, d):
    li = B.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                              "l_returnflag", "l_linestatus", "l_shipdate")
    od = B.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).withColumn(
        "person", F.concat(F.lit("P"), F.col("o_custkey").cast("string"))).withColumn(
        "term", F.concat("l_returnflag", "l_linestatus")).withColumn("unit", B.unit_expr())


def primary_care(spark, d) -> str:
    x = _lines(spark, d)
    date = F.when(F.col("l_orderkey") % 29 == 0, F.lit(None).cast("string")) \
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    out = x.select(F.col("person").alias("pseudo_nhs_number"), date.alias("clinical_effective_date"),
                   F.col("term").alias("original_term"), F.col("l_partkey").cast("string").alias("original_code"),
                   F.col("l_quantity").cast("string").alias("result_value"),
                   F.col("unit").alias("result_value_units"))
    return write_text_table(out, spark, "extract-primary-care", ",", "NULL")


NDA_COLUMNS = {"BMI": ("BMI_DATE", "BMI_VALUE"), "CHOL": ("CHOLESTEROL_DATE", "CHOL_VALUE"),
               "HBA1C": ("HBA1C_DATE", "HBA1C_MMOL_VALUE")}


def nda(spark, d, measure: str = "BMI") -> str:
    x = _lines(spark, d)
    date_col, value_col = NDA_COLUMNS[measure]
    out = x.select(F.col("person").alias("STUDY_ID"),
                   F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss.SSS").alias(date_col),
                   F.year("l_shipdate").cast("string").alias("AUDIT_YEAR"),
                   F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity").cast("string"))
                   .alias(value_col))
    return write_text_table(out, spark, f"extract-nda-{measure.lower()}", "|")


def nda_bmi(spark, d) -> str:
    return nda(spark, d, "BMI")


def nda_bp(spark, d) -> str:
    x = _lines(spark, d)
    out = x.select(F.col("person").alias("STUDY_ID"), F.year("l_shipdate").cast("string").alias("AUDIT_YEAR"),
                   F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("BP_Date"),
                   F.when(F.col("l_linenumber") == 6, F.lit(None)).otherwise((F.col("l_quantity") + 50).cast("string"))
                   .alias("DIASTOLIC_VALUE"),
                   (F.col("l_quantity") + 90).cast("string").alias("SYSTOLIC_VALUE"))
    return write_text_table(out, spark, "extract-nda-bp", "|")


def hes(spark, d) -> str:
    out = B.stays_raw(spark, d).withColumn("EPIKEY", F.lit("x"))
    return write_text_table(out, spark, "extract-hes", "|")


def bradford_path(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 8
    q = _q()
    res = (F.when(k == 0, F.concat(F.lit("<"), q)).when(k == 1, F.concat(F.lit(">"), q))
           .when(k == 2, F.concat(F.lit("Less than "), q)).when(k == 3, F.concat(F.lit(" "), q))
           .when(k == 4, F.lit("NA")).when(k == 5, F.lit("See comment"))
           .when(k == 6, F.concat(F.lit("Greater than "), q)).otherwise(q))
    out = x.select(F.col("person").alias("PseudoNHS_2023_04_24"),
                   F.date_format("l_shipdate", "yyyy-MM-dd").alias("lab_test_performed_date"),
                   F.col("term").alias("EVENT_DESCRIPTION"), res.alias("RESULT"), F.col("unit").alias("RESULT_UNIT_DESC"))
    return write_text_table(out, spark, "extract-bradford-path", "\t")


def barts_2022_03(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 6
    q = _q()
    res = (F.when(k == 0, F.concat(F.lit("< "), q)).when(k == 1, F.concat(F.lit("<"), q))
           .when(k == 2, F.concat(F.lit(">"), q)).when(k == 3, F.lit("NA"))
           .when(k == 4, F.concat(q, F.lit(" -"))).otherwise(q))
    desc = F.when(F.col("l_orderkey") % 17 == 0, F.concat("term", F.lit(", repeat"))).otherwise(F.col("term"))
    out = x.select(F.col("person").alias("PseudoNHSnumber"),
                   F.date_format("l_shipdate", "yyyy-MM-dd HH:mm").alias("ReportDate"),
                   desc.alias("TestDesc"), res.alias("ResultTxt"), F.col("unit").alias("ResultUnit"))
    return write_text_table(out, spark, "extract-barts-2022-03", ",")


def bradford_meas(spark, d) -> str:
    x = _lines(spark, d)
    n = F.col("l_linenumber") % 4
    title = (F.when(n == 0, "Weight Measured").when(n == 1, "HEIGHT").when(n == 2, "Body Mass Index")
             .otherwise("Pulse rate"))
    out = x.select(F.col("person").alias("PseudoNHS"), F.lit("40").alias("age_at_measurement"),
                   F.date_format("l_shipdate", "dd/MM/yyyy").alias("date_of_measurement"),
                   F.col("l_partkey").cast("string").alias("EVENT_CD"), title.alias("EVENT_TITLE"),
                   _q().alias("EVENT_ANSWER"))
    return write_text_table(out, spark, "extract-bradford-meas", "\t")


def bradford_meas_2024(spark, d) -> str:
    x = _lines(spark, d)
    n, k, q = F.col("l_linenumber") % 6, F.col("l_orderkey") % 7, _q()
    title = (F.when(n == 0, "weight").when(n == 1, "standing height").when(n == 2, "body mass index").when(n == 3, "blood pressure")
             .when(n == 4, "glucose (fasting)").otherwise("Pulse rate"))
    answer = F.when(k == 1, F.concat(q, F.lit(" - "), q)).when(k == 2, F.concat(q, F.lit("kg"))).when(k == 3, F.concat(q, F.lit("/"), q)).otherwise(q)
    out = x.select(F.col("person").alias("PseudoNHS_2024-07-10"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_of_measurement"),
                   F.col("l_partkey").cast("string").alias("EVENT_CD"), title.alias("EVENT_TITLE"), answer.alias("EVENT_ANSWER"))
    return write_text_table(out, spark, "extract-bradford-meas-2024", "\t")


def barts_meas(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 5
    q = _q()
    res = (F.when(k == 0, F.concat(q, F.lit("cm"))).when(k == 1, F.concat(F.lit("."), q))
           .when(k == 2, F.lit("3.6.1")).otherwise(q))
    stamp = F.concat(F.date_format("l_shipdate", "MMM d yyyy"), F.lit("  "), F.date_format("l_shipdate", "h:mma"))
    out = x.select(F.col("person").alias("PseudoNHS_2023_04_24"), F.lit("sys").alias("SystemLookup"),
                   stamp.alias("ClinicalSignificanceDate"), res.alias("EventResult"),
                   F.col("unit").alias("UnitsDesc"), F.col("term").alias("EventType"))
    return write_text_table(out, spark, "extract-barts-meas", "\t")


def bradford_path_2024(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 6
    q = _q()
    res = (F.when(k == 0, F.concat(F.lit("Less than "), q)).when(k == 1, F.lit("NA"))
           .when(k == 2, F.lit("Not detected")).when(k == 3, F.lit("-No evidence of past infection."))
           .when(k == 4, F.concat(F.lit("<"), q)).otherwise(q))
    out = x.select(F.col("person").alias("PseudoNHS_2024-07-10"),
                   F.date_format("l_shipdate", "yyyy-MM-dd").alias("lab_test_performed_date"),
                   F.col("term").alias("EVENT_DESCRIPTION"), res.alias("RESULT"), F.col("unit").alias("RESULT_UNIT_DESC"))
    return write_text_table(out, spark, "extract-bradford-path-2024", "\t")


def barts_meas_2024(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 7
    q = _q()
    res = (F.when(k == 0, F.lit(".")).when(k == 1, F.concat(q, F.lit("x"))).when(k == 2, F.lit("3.6.1"))
           .when(k == 3, F.concat(F.lit("1,"), q)).otherwise(q))
    term = F.when(k == 3, F.lit("Child's Birth Weight (g)")).otherwise(F.col("term"))
    units = F.when(k == 4, F.lit("0")).otherwise(F.col("unit"))
    text = F.when(F.col("l_orderkey") % 13 == 0, F.lit("free\ttext")).otherwise(F.lit("note"))
    stamp = F.concat(F.date_format("l_shipdate", "MMM d yyyy"), F.lit("  "), F.date_format("l_shipdate", "h:mma"))
    out = x.select(F.col("person").alias("PseudoNHS_2024-07-10"), F.lit("sys").alias("SystemLookup"),
                   stamp.alias("ClinicalSignificanceDate"), F.lit("").alias("ResultNumeric"), res.alias("EventResult"),
                   F.lit("u").alias("UnitsCode"), units.alias("UnitsDesc"), F.lit("n").alias("NormalCode"),
                   F.lit("n").alias("NormalDesc"), F.lit("0").alias("LowValue"), F.lit("9").alias("HighValue"),
                   text.alias("EventText"), term.alias("EventType"), F.lit("p").alias("EventParent"))
    return write_text_table(out, spark, "extract-barts-meas-2024", "\t")


def barts_path_2024(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 9
    q = _q()
    res = (F.when(k == 0, F.concat(F.lit('"'), q, F.lit('"'))).when(k == 1, F.lit("NA"))
           .when(k == 2, F.concat(F.lit("("), q, F.lit(")"))).when(k == 3, F.concat(q, F.lit("cm")))
           .when(k == 4, F.concat(F.lit("+-"), q)).when(k == 5, F.concat(q, F.lit("%")))
           .when(k == 6, F.lit("1:32")).when(k == 7, F.concat(F.lit("< "), q)).otherwise(q))
    date = F.when(F.col("l_orderkey") % 11 == 0, F.lit("unknown")) \
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm"))
    out = x.select(F.col("person").alias("PseudoNHS_2024-07-10"), date.alias("ReportDate"),
                   F.col("term").alias("TestDesc"), res.alias("ResultTxt"), F.col("unit").alias("ResultUnit"),
                   F.lit('say "hi"').alias("Comment"))
    return write_text_table(out, spark, "extract-barts-path-2024", "\t")


def barts_path_2023(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 10
    q = _q()
    iso = F.date_format("l_shipdate", "yyyy-MM-dd")
    res = (F.when(k == 0, F.concat(F.lit("<"), q)).when(k == 1, F.concat(F.lit("{"), q, F.lit("}")))
           .when(k == 2, F.concat(q, F.lit("%"))).when(k == 3, F.concat(q, F.lit(" g/l")))
           .when(k == 4, F.lit("NA")).when(k == 5, F.lit("Insufficient sample"))
           .when(k == 6, F.concat(F.lit('"'), q)).when(k == 7, F.lit("abc"))
           .when(k == 8, F.concat(F.lit(" "), q, F.lit(" -"))).otherwise(q))
    desc = F.when(F.col("l_orderkey") % 13 == 0, F.concat(F.lit('"'), "term")).otherwise(F.col("term"))
    report_date = F.when(F.col("l_orderkey") % 4 == 0, F.lit("garbage")).otherwise(F.concat(iso, F.lit(" 10:00")))
    report = F.concat(F.lit("4"), F.substring(iso, 2, 100), F.lit(" 10:00"))
    line = F.concat_ws("\t", "person", report_date, report, F.concat(iso, F.lit(" 08:00")), desc, res,
                       F.coalesce("unit", F.lit("")))
    header = "\t".join(["PseudoNHS_2023_04_24", "ReportDate", "Report", "RequestDate", "TestDesc", "ResultTxt",
                        "ResultUnit"])
    return write_lines(spark, x.select(line.alias("value")), "extract-barts-path-2023-05", header)


def barts_path_2023_12(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 9
    q = _q()
    res = (F.when(k == 0, F.concat(F.lit("<"), q)).when(k == 1, F.concat(F.lit("("), q, F.lit(")")))
           .when(k == 2, F.concat(F.lit("*{"), q, F.lit("}"))).when(k == 3, F.concat(F.lit("+/-"), q))
           .when(k == 4, F.lit("**")).when(k == 5, F.concat(F.lit("x"), q))
           .when(k == 6, F.lit("14/07/2011, 16:51")).when(k == 7, F.concat(F.lit(" "), q)).otherwise(q))
    filler = F.when(F.col("l_orderkey") % 17 == 0, F.lit("a\tb")).otherwise(F.lit("f"))
    line = F.concat_ws("\t", "person", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm"), "term", res,
                       F.coalesce("unit", F.lit("")), filler, *[F.lit("f")] * 11)
    header = "\t".join(["PseudoNHS_2023_11_08", "ReportDate", "TestDesc", "ResultTxt", "ResultUnit"]
                       + [f"C{i}" for i in range(1, 13)])
    return write_lines(spark, x.select(line.alias("value")), "extract-barts-path-2023-12", header)


def barts_meas_2023_12(spark, d) -> str:
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 10
    q = _q()
    res = (F.when(k == 0, F.concat(F.lit(" "), q)).when(k == 1, F.concat(F.lit(">"), q))
           .when(k == 2, F.concat(F.lit('"'), q, F.lit('"'))).when(k == 3, F.lit("10:00"))
           .when(k == 4, F.concat(q, F.lit("&"))).when(k == 5, F.lit("1-2"))
           .when(k == 6, F.concat(F.lit("a"), q)).when(k == 7, F.concat(q, F.lit("-")))
           .when(k == 8, F.lit("1.2.3")).otherwise(q))
    stamp = F.concat(F.date_format("l_shipdate", "MMM d yyyy"), F.lit("  "), F.date_format("l_shipdate", "h:mma"))
    text = F.when(F.col("l_orderkey") % 19 == 0, F.lit('say "a\tb"')).otherwise(F.lit('say "x"'))
    line = F.concat_ws("\t", "person", F.lit("sys"), stamp, res, F.lit("u"), F.coalesce("unit", F.lit("")),
                       F.lit("n"), F.lit("n"), F.lit("0"), F.lit("9"), text, "term", F.lit("p"), F.lit("z"))
    header = "\t".join(["PseudoNHS_2023_11_08", "SystemLookup", "ClinicalSignificanceDate", "EventResult",
                        "UnitsCode", "UnitsDesc", "NormalCode", "NormalDesc", "LowValue", "HighValue", "EventText",
                        "EventType", "EventParent", "Extra"])
    return write_lines(spark, x.select(line.alias("value")), "extract-barts-meas-2023-12", header)


BARTS_2021_04_FILES = [("Good_April2021.csv", 0), ("Other_April2021.csv", 1), ("MCH_April2021.csv", 2)]


def barts_2021_04(spark, d) -> str:
    """Several extract files in one folder (one per test, the last on the problem list),
    headerless in meaning: the first line is skipped and columns are positional."""
    x = _lines(spark, d)
    k = F.col("l_orderkey") % 5
    q = _q()
    res = (F.when(k == 0, F.concat(F.lit("<"), q)).when(k == 1, F.concat(F.lit(">"), q))
           .when(k == 2, F.concat(F.lit(" "), q)).when(k == 3, F.lit("NULL")).otherwise(F.lit("08/01/2014")))
    out = x.select((F.col("l_orderkey") % 3).alias("_g"), F.col("person").alias("a"), F.lit("x").alias("b"),
                   F.col("term").alias("c"), F.date_format("l_shipdate", "dd/MM/yyyy").alias("d"), res.alias("e"),
                   F.coalesce("unit", F.lit("NULL")).alias("f"))
    root = staging_path(spark, "extract-barts-2021-04")
    for name, g in BARTS_2021_04_FILES:   # a fixed list of three extract files
        (out.filter(F.col("_g") == g).drop("_g").write.mode("overwrite").option("header", True)
         .option("quote", '"').option("escape", '"').csv(f"{root}/{name}"))
    return f"{root}/*.csv"


def linkage(spark, d) -> str:
    lk = B.linkage(spark, d)
    out = lk.select("OrageneID", F.lit("1").alias("Number of OrageneIDs with this NHS number"),
                    F.col("s1qst_gender").alias("S1QST gender"), F.lit("yes").alias("HasValidNHS"),
                    F.col("pseudo_nhs_number").alias("pseudonhs_2024-07-10"),
                    F.col("gsa_id").alias("51176GSA-T0PMedr3 Jan2024release"),
                    F.lit(None).cast("string").alias("44628exomes_release_2023-JUL-07"),
                    F.col("exome_id").alias("55273exomes_release_2024-OCT-08"))
    return write_text_table(out, spark, "extract-linkage", ",")


def dictionaries(spark) -> dict[str, str]:
    return written_dictionaries(spark, B.traits(spark), B.aliases(spark), B.units(spark))


def written_dictionaries(spark, traits: DataFrame, aliases: DataFrame, units: DataFrame) -> dict[str, str]:
    return {"traits": write_text_table(traits, spark, "dict-traits", ","),
            "aliases": write_text_table(aliases, spark, "dict-aliases", ","),
            "units": write_text_table(units, spark, "dict-units", ",")}
