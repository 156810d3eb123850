"""People: valid ids, demographics, ages and genotype-id cohorts.

People tables are bounded by the cohort (tens of thousands to millions of rows), not by the
readings. No join carries a hint: Spark broadcasts them below its size threshold and otherwise
shuffles (AQE splits a hot person on the readings side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitflow import schema as S
from traitflow.functions import scalars as X
from traitflow.operators.dedup import dedup_subset

GENOTYPE_COLUMNS = {"gsa": "gsa_id", "exome": "exome_id"}


def valid_pseudo_nhs_numbers(linkage: DataFrame) -> DataFrame:
    return linkage.select("pseudo_nhs_number").filter(F.col("pseudo_nhs_number").isNotNull()).distinct()


def questionnaire_demographics(questionnaire: DataFrame) -> DataFrame:
    """Questionnaire -> (OrageneID, dob, gender); month-year of birth 'NA' dropped, gender
    codes mapped strictly, one row per OrageneID (smallest dob, then gender)."""
    q = (questionnaire
         .filter(F.col("S1QST_MM-YYYY_ofBirth") != "NA")
         .select(F.col("S1QST_Oragene_ID").alias("OrageneID"),
                 X.month_year_to_dob(F.col("S1QST_MM-YYYY_ofBirth")).alias("dob"),
                 X.map_strict(F.col("S1QST_Gender"), S.GENDER_CODES, "gender").alias("gender")))
    return dedup_subset(q, ["OrageneID"], ["dob", "gender"])


def valid_demographics(linkage: DataFrame, demographics: DataFrame) -> DataFrame:
    """(pseudo_nhs_number, OrageneID, dob, gender): one row per person (smallest OrageneID)."""
    people = dedup_subset(linkage.select("pseudo_nhs_number", "OrageneID")
                          .filter(F.col("pseudo_nhs_number").isNotNull()),
                          ["pseudo_nhs_number"], ["OrageneID"])
    return people.join(demographics, "OrageneID", "left").select("pseudo_nhs_number", "OrageneID", "dob", "gender")


def genotype_ids(linkage: DataFrame, kind: str = "gsa") -> DataFrame:
    """(pseudo_nhs_number, IID) for one genotype cohort: non-null id, person and OrageneID,
    unique on person and on OrageneID (deterministic survivors)."""
    col = GENOTYPE_COLUMNS[kind]
    ids = linkage.filter(F.col(col).isNotNull() & F.col("pseudo_nhs_number").isNotNull()
                         & F.col("OrageneID").isNotNull()) \
        .select("pseudo_nhs_number", "OrageneID", F.col(col).alias("IID"))
    ids = dedup_subset(ids, ["pseudo_nhs_number"], ["OrageneID", "IID"])
    ids = dedup_subset(ids, ["OrageneID"], ["pseudo_nhs_number", "IID"])
    return ids.select("pseudo_nhs_number", "IID")


def join_valid_people_semi(df: DataFrame, valid: DataFrame) -> DataFrame:
    return df.join(valid.select("pseudo_nhs_number"), "pseudo_nhs_number", "left_semi")


def join_demographics(df: DataFrame, demographics: DataFrame) -> DataFrame:
    """Left join dob/gender/OrageneID and derive ``age_at_test`` (null dob -> null age)."""
    d = demographics.select("pseudo_nhs_number", "OrageneID", "dob", "gender")
    out = df.join(d, "pseudo_nhs_number", "left")
    return out.withColumn("age_at_test", X.age_at_test("test_date", "dob"))


def join_genotype_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids, "pseudo_nhs_number", "inner")
