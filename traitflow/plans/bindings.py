"""Model tables built from the driver's TPC-H-style tables (the same expressions are written
in SQL in ``catalog.py`` for the DuckDB oracle).

  readings      lineitem x orders: person 'P'||o_custkey, ship date, term flag||status,
                value l_quantity, unit by line number, provenance by supplier
  dense         events: person 'U'||user_id, date, event type, floor(value / 100)
  stays         orders: admission order date, discharge after o_orderkey % 12 days
  linkage       customer: ids with gaps; questionnaire: month-year of birth, gender code
  dictionaries  three traits over six terms, unit factors, ranges cutting both tails
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.functions import scalars as X
from traitflow.operators import filters as FL

AS_OF = "2001-06-30"

# Fixed dictionaries used with the driver tables.
TRAITS = [("Alpha", "g/L", 15.0, 400.0), ("HbA1c", "mmol/mol", 20.0, 195.0),
          ("Rho", "g/dL", 2.0, 45.0), ("#Theta", "g/L", 0.0, 1.0)]
ALIASES = [("Alpha", "AF"), ("Alpha", "AO"), ("HbA1c", "NF"), ("HbA1c", "NO"),
           ("Rho", "RF"), ("Rho", "RO")]
UNITS = [("g/dL", "g/L", 10.0), ("g/L", "g/L", 1.0), ("g/L", "g/dL", 0.1),
         ("g/dL", "g/dL", 1.0), ("mmol/mol", "mmol/mol", 1.0), ("#g/L", "g/L", 1.0)]
PROVENANCE_ORDER = ["pull_a", "pull_b", "pull_c", "pull_d"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _literal_table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """Fixed rows as a plan of known size (a table made from Python rows has none, so Spark would
    shuffle the readings for it)."""
    structs = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, columns)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def traits(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, TRAITS, ["trait", "target_units", "min", "max"])


def aliases(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, ALIASES, ["trait", "alias"])


def units(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, UNITS, ["result_value_units", "target", "multiplication_factor"])


def unit_expr() -> F.Column:
    n = F.col("l_linenumber") % 4
    return (F.when(n == 0, "g/dL").when(n == 1, "g/L")
            .when(n == 2, F.when(F.col("l_orderkey") % 2 == 0, "%").otherwise("zz")))


def provenance_expr() -> F.Column:
    n = F.col("l_suppkey") % 4
    return (F.when(n == 0, "pull_a").when(n == 1, "pull_b").when(n == 2, "pull_c").otherwise("pull_d"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                 "l_returnflag", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("pseudo_nhs_number"),
        F.col("l_shipdate").cast("date").alias("test_date"),
        F.concat("l_returnflag", "l_linestatus").alias("original_term"),
        F.col("l_quantity").alias("result"),
        unit_expr().alias("result_value_units"),
        provenance_expr().alias("provenance"),
        F.when(F.col("l_suppkey") % 2 == 0, "primary_care").otherwise("secondary_care").alias("source"))


def dense_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("pseudo_nhs_number"),
        F.col("ts").cast("date").alias("test_date"),
        F.col("event_type").alias("trait"),
        F.floor(F.col("value") / 100).cast("double").alias("final"))


def stays_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = table(spark, sf_dir, "orders")
    adm = F.col("o_orderdate").cast("date")
    dis = F.when(F.col("o_orderkey") % 53 == 0, F.lit(None).cast("date")) \
        .otherwise(F.date_add(adm, (F.col("o_orderkey") % 12).cast("int")))
    return od.select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("STUDY_ID"),
                     F.date_format(adm, "yyyy-MM-dd").alias("ADMIDATE"),
                     F.date_format(dis, "yyyy-MM-dd").alias("DISDATE"))


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = stays_raw(spark, sf_dir)
    parsed = raw.select(F.col("STUDY_ID").alias("pseudo_nhs_number"),
                        X.day_bounds("ADMIDATE").alias("hospital_admission_datetime"),
                        X.day_bounds("DISDATE", end=True).alias("hospital_discharge_datetime"))
    # parsed once a row: else every later filter on a date, which Spark moves below the distinct, parses it again
    once = FL.computed(parsed, ["hospital_admission_datetime", "hospital_discharge_datetime"])
    return once.withColumn("hospital_stay_type", F.lit("APC")).distinct()


def _dob() -> F.Column:
    return F.date_add(F.lit("1930-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int"))


def linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    sk = k.cast("string")
    return c.select(
        F.concat(F.lit("O"), sk).alias("OrageneID"),
        F.when(k % 2 == 0, "2").otherwise("1").alias("s1qst_gender"),
        F.when(k % 11 == 5, F.lit(None).cast("string")).otherwise(F.concat(F.lit("P"), sk)).alias("pseudo_nhs_number"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("G"), sk)).alias("gsa_id"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("X"), sk)).alias("exome_id"))


def questionnaire(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("O"), k.cast("string")).alias("S1QST_Oragene_ID"),
        F.when(k % 2 == 0, "2").otherwise("1").alias("S1QST_Gender"),
        F.when(k % 13 == 0, "NA").otherwise(F.date_format(_dob(), "MM-yyyy")).alias("S1QST_MM-YYYY_ofBirth"))


# Dictionaries at a release's shape (150 traits, two targets per unit, disabled ``#`` rows), from ``part``.

def part_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size", "p_retailprice")
    name = F.concat_ws(" ", "p_brand", "p_type")
    out = p.groupBy("p_brand", "p_type").agg(F.min("p_size").alias("s"), F.min("p_retailprice").alias("min"), F.max("p_retailprice").alias("max"))
    return out.select(F.when(F.col("p_brand") == "Brand#7", F.concat(F.lit("#"), name)).otherwise(name).alias("trait"),
                      F.concat(F.lit("u"), (F.col("s") % 13).cast("string")).alias("target_units"), "min", "max")


def part_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_brand", "p_type", "p_name", "p_size").filter(F.col("p_type") != "SMALL")
    return p.select(F.concat_ws(" ", "p_brand", "p_type").alias("trait"),
                    F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("alias")).distinct()


def part_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_size").distinct()
    unit, n = F.concat(F.lit("v"), F.col("p_size").cast("string")), F.col("p_size")
    target = F.explode(F.array(n % 13, (n + 1) % 13))
    return p.select(unit.alias("result_value_units"), target.alias("t"), n).select(
        "result_value_units", F.concat(F.lit("u"), F.col("t").cast("string")).alias("target"), (F.col("p_size") / 8.0).alias("multiplication_factor"))
