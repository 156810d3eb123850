"""Query catalog: one Spark callable (spark, sf_dir) -> DataFrame per operator key, and the
DuckDB SQL computing the same result from the same tables.

Presentation rules shared by both sides: region lists are compared as comma-joined text,
averages are rounded to 9 decimals, every computed column is aliased.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traitflow import schema as S
from traitflow.functions import regions as RF
from traitflow.functions import scalars as X
from traitflow.operators import audit as AU
from traitflow.operators import combo as CO
from traitflow.operators import dedup as DD
from traitflow.operators import filters as FL
from traitflow.operators import intervals as IV
from traitflow.operators import people as PE
from traitflow.operators import regions as RG
from traitflow.operators import sketches as SE
from traitflow.operators import stats as ST
from traitflow.operators import tiles as TI
from traitflow.operators import traits as TR
from traitflow.plans import bindings as B
from traitflow.plans import pipeline as P
from traitflow.plans.sql_bindings import REGION_TEXT, with_clause
from traitflow.plans.staging import fingerprint, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def region_text(c="region_types"):
    return F.array_join(F.col(c), ",").alias(c)


# --- shared Spark building blocks ---------------------------------------------------------

def segments(spark, d):
    return staged(spark, f"segments:{d}", lambda: IV.admission_windows(B.stays(spark, d)), fingerprint(spark, d))


def ranged(spark, d):
    return P.ranged_readings(B.readings(spark, d), B.traits(spark), B.aliases(spark), B.units(spark))


def pre_tiling(spark, d):
    return P.people_restricted(ranged(spark, d), B.linkage(spark, d), B.questionnaire(spark, d), B.AS_OF)


def tiled(spark, d):
    """The tiled, region-classified readings, written once and shared by every output query."""
    return staged(spark, f"tiled:{d}", lambda: P.quant_pipeline(
        B.readings(spark, d), B.stays(spark, d), B.traits(spark), B.aliases(spark), B.units(spark),
        B.linkage(spark, d), B.questionnaire(spark, d), B.AS_OF, segments=segments(spark, d)), fingerprint(spark, d))


def tiled_settings(spark, d):
    return RG.setting_split(tiled(spark, d))


def seg_cols(df):
    return df.select(F.col("pseudo_nhs_number").alias("id"), F.col("start_date").alias("s"),
                     F.col("end_date").alias("e"), region_text())


SEG_SQL = "SELECT id, s, e, " + REGION_TEXT.format(t="") + " AS region_types FROM segs"
TILED_COLS = "pseudo_nhs_number, trait, unit, value, date, gender, age_at_test, minmax_outlier, region_types"


# --- flagship -------------------------------------------------------------------------------

@query("quant_pipeline", with_clause("tiled") + f"SELECT {TILED_COLS} FROM tiled")
def q_quant_pipeline(spark, d):
    t = tiled(spark, d)
    return t.select(*[region_text() if c == "region_types" else c for c in S.TILED_COLUMNS])


# --- interval algebra -----------------------------------------------------------------------

@query("admission_windows", with_clause("segs") + SEG_SQL)
def q_admission_windows(spark, d):
    return seg_cols(segments(spark, d))


@query("split_and_remerge_intervals", with_clause("m1") + "SELECT id, s, e FROM m1")
def q_split_and_remerge(spark, d):
    st = _stay_intervals(spark, d)
    m = IV.split_and_remerge_intervals(st, "pseudo_nhs_number", "hospital_admission_datetime",
                                       "hospital_discharge_datetime")
    return m.select(F.col("pseudo_nhs_number").alias("id"), F.col("hospital_admission_datetime").alias("s"),
                    F.col("hospital_discharge_datetime").alias("e"))


def _stay_intervals(spark, d):
    return spread(B.stays(spark, d), "pseudo_nhs_number").withColumn("region_types", F.array(F.lit("APC")))


_STAY_COLS = ("pseudo_nhs_number", "hospital_admission_datetime", "hospital_discharge_datetime")


def _seg_out(df, extra=()):
    return df.select(F.col("_id").alias("id"), F.col("_x").alias("s"), F.col("_e").alias("e"),
                     RF.canonical_regions(F.col("_a"), F.col("_bb"), F.col("_ba")).alias("_r"), *extra) \
        .withColumn("region_types", F.array_join("_r", ",")).drop("_r")


@query("region_set_agg", with_clause("segs_cov") + "SELECT id, s, e, " + REGION_TEXT.format(t="")
       + " AS region_types FROM segs_cov")
def q_region_set_agg(spark, d):
    return _seg_out(IV.covered_segments(_buffers(spark, d)))


@query("island_breaks", with_clause("segs_brk") + "SELECT id, s, e, " + REGION_TEXT.format(t="")
       + " AS region_types, n AS is_new FROM segs_brk")
def q_island_breaks(spark, d):
    return _seg_out(IV.covered_segments(_buffers(spark, d)), [F.col("_new").alias("is_new")])


@query("island_ids", with_clause("segs_isl") + "SELECT id, s, e, " + REGION_TEXT.format(t="")
       + " AS region_types, g AS island FROM segs_isl")
def q_island_ids(spark, d):
    return _seg_out(IV.covered_segments(_buffers(spark, d)), [F.col("_g").alias("island")])


@query("islands_min_max", with_clause("segs") + SEG_SQL)
def q_islands_min_max(spark, d):
    return seg_cols(IV.islands_min_max(IV.covered_segments(_buffers(spark, d))))


def _buffers(spark, d):
    m = IV.split_and_remerge_intervals(_stay_intervals(spark, d), *_STAY_COLS)
    days = (m.select("pseudo_nhs_number", X.round_to_day("hospital_admission_datetime").alias("start_date"),
                     X.round_to_day("hospital_discharge_datetime").alias("end_date"))
            .filter(F.datediff("end_date", "start_date") > S.MIN_ADMISSION_DAYS))
    return IV.add_buffers(days)


@query("add_buffers", with_clause("buf") + """SELECT id, s, e,
    CASE WHEN a = 1 THEN 'APC' WHEN bb = 1 THEN 'buffer_before' ELSE 'buffer_after' END AS region_types FROM buf""")
def q_add_buffers(spark, d):
    st = B.stays(spark, d).withColumn("region_types", F.array(F.lit("APC")))
    m = IV.split_and_remerge_intervals(st, "pseudo_nhs_number", "hospital_admission_datetime",
                                       "hospital_discharge_datetime")
    days = (m.select("pseudo_nhs_number", X.round_to_day("hospital_admission_datetime").alias("start_date"),
                     X.round_to_day("hospital_discharge_datetime").alias("end_date"))
            .filter(F.datediff("end_date", "start_date") > S.MIN_ADMISSION_DAYS))
    return seg_cols(IV.add_buffers(days))


@query("round_to_day", with_clause("m1") + """SELECT id,
    CAST(date_trunc('day', s + INTERVAL 12 HOUR) AS DATE) AS start_date,
    CAST(date_trunc('day', e + INTERVAL 12 HOUR) AS DATE) AS end_date FROM m1""")
def q_round_to_day(spark, d):
    st = B.stays(spark, d).withColumn("region_types", F.array(F.lit("APC")))
    m = IV.split_and_remerge_intervals(st, "pseudo_nhs_number", "hospital_admission_datetime",
                                       "hospital_discharge_datetime")
    return m.select(F.col("pseudo_nhs_number").alias("id"),
                    X.round_to_day("hospital_admission_datetime").alias("start_date"),
                    X.round_to_day("hospital_discharge_datetime").alias("end_date"))


@query("day_bounds", with_clause("stays_raw") + """SELECT STUDY_ID,
    CAST(adm_d AS TIMESTAMP) AS admission, CAST(dis_d AS TIMESTAMP) + INTERVAL '23:59:59' AS discharge
    FROM stays_raw""")
def q_day_bounds(spark, d):
    r = B.stays_raw(spark, d)
    return r.select("STUDY_ID", X.day_bounds("ADMIDATE").alias("admission"),
                    X.day_bounds("DISDATE", end=True).alias("discharge"))


@query("dedup_full_row", with_clause("stays") + "SELECT pseudo_nhs_number, adm, dis FROM stays")
def q_dedup_full_row(spark, d):
    r = B.stays_raw(spark, d)
    st = r.select(F.col("STUDY_ID").alias("pseudo_nhs_number"), X.day_bounds("ADMIDATE").alias("adm"),
                  X.day_bounds("DISDATE", end=True).alias("dis"))
    return DD.dedup_full_row(st.unionByName(st))


@query("admission_timeline", with_clause("segs") + """SELECT id AS pseudo_nhs_number, s AS start_date,
    e AS end_date, date_diff('day', s, e) AS days, """ + REGION_TEXT.format(t="") + " AS regions FROM segs")
def q_admission_timeline(spark, d):
    return IV.admission_timeline(segments(spark, d))


@query("admission_length_histogram", with_clause("segs") + """, L AS (SELECT date_diff('day', s, e) AS days FROM segs),
    B AS (SELECT min(days) AS lo, max(days) AS hi FROM L)
    SELECT bin, lo + bin * ((hi - lo) / 50.0) AS bin_start, lo + (bin + 1) * ((hi - lo) / 50.0) AS bin_end,
           count(*) AS n
    FROM (SELECT CAST(CASE WHEN hi > lo THEN least(floor((days - lo) / ((hi - lo) / 50.0)), 49) ELSE 0 END
                 AS INTEGER) AS bin, lo, hi FROM L, B) x GROUP BY bin, lo, hi""")
def q_admission_length_histogram(spark, d):
    return IV.admission_length_histogram(segments(spark, d), 50)


@query("explode_regions", with_clause("segs") + """SELECT label, count(*) AS n FROM (
    SELECT 'APC' AS label FROM segs WHERE a = 1 UNION ALL SELECT 'buffer_before' FROM segs WHERE bb = 1
    UNION ALL SELECT 'buffer_after' FROM segs WHERE ba = 1) x GROUP BY label""")
def q_explode_regions(spark, d):
    return (segments(spark, d).select(F.explode("region_types").alias("label"))
            .groupBy("label").agg(F.count("*").alias("n")))


@query("list_functions", with_clause("segs") + """SELECT id, s, a = 1 AS has_apc,
    """ + REGION_TEXT.format(t="") + """ AS regions, a + bb + ba AS n_regions FROM segs""")
def q_list_functions(spark, d):
    s = segments(spark, d)
    return s.select(F.col("pseudo_nhs_number").alias("id"), F.col("start_date").alias("s"),
                    F.array_contains("region_types", "APC").alias("has_apc"),
                    F.array_join("region_types", ",").alias("regions"),
                    F.size("region_types").alias("n_regions"))


# --- regions on readings --------------------------------------------------------------------

@query("range_join_regions", with_clause("readings", "segs") + """SELECT p.pseudo_nhs_number, p.test_date,
    s.s AS start_date, s.e AS end_date, """ + REGION_TEXT.format(t="s.") + """ AS region_types
    FROM (SELECT DISTINCT pseudo_nhs_number, test_date FROM readings) p
    JOIN segs s ON p.pseudo_nhs_number = s.id AND p.test_date >= s.s AND p.test_date < s.e""")
def q_range_join_regions(spark, d):
    pts = B.readings(spark, d).select("pseudo_nhs_number", "test_date").distinct()
    j = RG.range_join_regions(pts, segments(spark, d))
    return j.select("pseudo_nhs_number", "test_date", "start_date", "end_date", region_text())


@query("interval_containment_join", with_clause("segs_seg", "buf") + """SELECT g.id, g.s, g.e, v.s AS interval_start, v.e AS interval_end,
    """ + REGION_TEXT.format(t="v.") + """ AS region_types FROM segs_seg g JOIN buf v ON g.id = v.id AND g.s >= v.s AND g.e <= v.e
    WHERE g.e IS NOT NULL""")
def q_interval_containment_join(spark, d):
    """Every elementary segment with each buffered interval that contains it, through the dyadic index."""
    buf = _buffers(spark, d)
    seg = IV.elementary_segments(buf).select("pseudo_nhs_number", F.col("start_date").alias("s"), F.col("end_date").alias("e"))
    j = RG.range_join_regions(seg, buf, date_col="s")
    return j.select(F.col("pseudo_nhs_number").alias("id"), "s", "e", F.col("start_date").alias("interval_start"),
                    F.col("end_date").alias("interval_end"), region_text())


@query("join_regions_m1", with_clause("readings", "segs") + """SELECT r.pseudo_nhs_number, r.test_date,
    r.original_term, r.result, r.result_value_units, r.provenance, """ + REGION_TEXT.format(t="s.") + """ AS region_types
    FROM readings r LEFT JOIN segs s ON r.pseudo_nhs_number = s.id AND r.test_date >= s.s AND r.test_date < s.e""")
def q_join_regions_m1(spark, d):
    r = B.readings(spark, d)
    out = RG.add_region_types(r, segments(spark, d))
    return out.select("pseudo_nhs_number", "test_date", "original_term", "result", "result_value_units",
                      "provenance", region_text())


def _flag_sql(t="s."):
    a, bb, ba = (f"coalesce({t}a = 1, false)", f"coalesce({t}bb = 1, false)", f"coalesce({t}ba = 1, false)")
    return {
        "IN_APC_ONLY": f"{a} AND NOT {bb} AND NOT {ba}", "IN_APC_ANY": a,
        "IN_BUFFER_BEFORE_ONLY": f"{bb} AND NOT {a} AND NOT {ba}", "IN_BUFFER_BEFORE_ANY": bb,
        "IN_BUFFER_AFTER_ONLY": f"{ba} AND NOT {a} AND NOT {bb}", "IN_BUFFER_AFTER_ANY": ba,
        "IN_BUFFERS_ONLY": f"({bb} OR {ba}) AND NOT {a}", "IN_BUFFERS_ANY": f"{bb} OR {ba}",
        "IN_TOTAL_EXCLUSION_ZONE": f"{a} OR {bb} OR {ba}", "OUT_OF_APC": f"NOT {a}",
        "OUT_OF_TOTAL_EXCLUSION_ZONE": f"NOT ({a} OR {bb} OR {ba})",
    }


@query("classify_regions", with_clause("readings", "segs") + "SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN {v} THEN 1 ELSE 0 END) AS BIGINT) AS {k}" for k, v in _flag_sql().items())
    + """, count(*) AS n FROM readings r
    LEFT JOIN segs s ON r.pseudo_nhs_number = s.id AND r.test_date >= s.s AND r.test_date < s.e""")
def q_classify_regions(spark, d):
    c = RG.classify_regions(RG.add_region_types(B.readings(spark, d), segments(spark, d)))
    return c.agg(*[F.sum(F.col(k).cast("long")).alias(k) for k in RF.CATEGORIES], F.count("*").alias("n"))


@query("classify_regions_join", with_clause("readings", "segs") + """SELECT regions, """ + ", ".join(
    f"{v} AS {k}" for k, v in _flag_sql("").items()) + """, n FROM (
      SELECT """ + REGION_TEXT.format(t="s.") + """ AS regions, s.a, s.bb, s.ba, count(*) AS n FROM readings r
      LEFT JOIN segs s ON r.pseudo_nhs_number = s.id AND r.test_date >= s.s AND r.test_date < s.e
      GROUP BY ALL) x""")
def q_classify_regions_join(spark, d):
    """Region lists of the readings joined to the eight-subset category table (null-safe)."""
    r = RG.add_region_types(B.readings(spark, d), segments(spark, d))
    counts = r.groupBy("region_types").agg(F.count("*").alias("n"))
    table = F.broadcast(RG.region_subset_table(spark))  # 8 rows
    j = counts.join(table, counts["region_types"].eqNullSafe(table["region_types"]), "inner")
    return j.select(F.array_join(counts["region_types"], ",").alias("regions"),
                    *[table[k] for k in RF.CATEGORIES], "n")


@query("setting_split", with_clause("tiled_set") + """SELECT setting, trait, count(*) AS n,
    count(DISTINCT pseudo_nhs_number) AS n_people FROM tiled_set GROUP BY setting, trait""")
def q_setting_split(spark, d):
    people = spread(tiled(spark, d).select("pseudo_nhs_number", "trait", "region_types"), "pseudo_nhs_number")
    return (RG.setting_split(people).groupBy("setting", "trait")
            .agg(F.count("*").alias("n"), F.countDistinct("pseudo_nhs_number").alias("n_people")))


# --- traits, units, ranges ------------------------------------------------------------------

PART_DICT = """WITH pt AS (SELECT CASE WHEN p_brand = 'Brand#7' THEN '#' ELSE '' END || p_brand || ' ' || p_type AS trait,
      'u' || CAST(min(p_size) % 13 AS VARCHAR) AS target_units, min(p_retailprice) AS "min", max(p_retailprice) AS "max"
    FROM part GROUP BY p_brand, p_type),
  pa AS (SELECT DISTINCT p_brand || ' ' || p_type AS trait, p_name || ' ' || CAST(p_size AS VARCHAR) AS alias FROM part WHERE p_type <> 'SMALL'),
  pd AS (SELECT pt.trait, target_units, "min", "max", alias FROM pt LEFT JOIN pa ON pt.trait = pa.trait)
"""


@query("trait_dictionary", PART_DICT + 'SELECT trait, target_units, "min", "max", alias FROM pd')
def q_trait_dictionary(spark, d):
    return TR.trait_dictionary(B.part_traits(spark, d), B.part_aliases(spark, d))


@query("join_terms_to_traits", with_clause("readings", "dict_d") + """SELECT r.original_term, d.trait,
    count(*) AS n FROM readings r LEFT JOIN dict_d d ON r.original_term = d.alias GROUP BY ALL""")
def q_join_terms_to_traits(spark, d):
    x = TR.join_terms_to_traits(B.readings(spark, d), TR.trait_dictionary(B.traits(spark), B.aliases(spark)))
    return x.groupBy("original_term", "trait").agg(F.count("*").alias("n"))


@query("join_unit_converter", with_clause("ranged0") + """SELECT trait, result_value_units, target,
    multiplication_factor, unit_matched, count(*) AS n FROM ranged0 GROUP BY ALL""")
def q_join_unit_converter(spark, d):
    x = TR.join_terms_to_traits(B.readings(spark, d), TR.trait_dictionary(B.traits(spark), B.aliases(spark)))
    x = TR.join_unit_converter(FL.filter_null_units(x.filter(F.col("trait").isNotNull())), B.units(spark))
    return x.groupBy("trait", "result_value_units", "target", "multiplication_factor", "unit_matched") \
        .agg(F.count("*").alias("n"))


@query("harmonise_units", with_clause("ranged") + """SELECT pseudo_nhs_number, test_date, original_term,
    result, result_value_units, provenance, trait, target_units, final, range_position,
    CASE WHEN final = 0 THEN log10(1e-10) WHEN final > 0 THEN log10(final) ELSE 'NaN'::DOUBLE END AS final_log10
    FROM ranged""")
def q_harmonise_units(spark, d):
    return ranged(spark, d).select("pseudo_nhs_number", "test_date", "original_term", "result",
                                   "result_value_units", "provenance", "trait", "target_units", "final",
                                   "range_position", "final_log10")


@query("range_position", with_clause("ranged") + """SELECT trait, range_position, count(*) AS n,
    min(final) AS lo, max(final) AS hi FROM ranged GROUP BY ALL""")
def q_range_position(spark, d):
    return ranged(spark, d).groupBy("trait", "range_position").agg(
        F.count("*").alias("n"), F.min("final").alias("lo"), F.max("final").alias("hi"))


@query("hba1c_percent_to_ifcc", with_clause("readings") + """SELECT pseudo_nhs_number, test_date, result,
    10.93::DOUBLE * result + (-23.5)::DOUBLE AS ifcc FROM readings WHERE result_value_units = '%'""")
def q_hba1c(spark, d):
    r = B.readings(spark, d).filter(F.col("result_value_units") == "%")
    return r.select("pseudo_nhs_number", "test_date", "result", X.hba1c_percent_to_ifcc("result").alias("ifcc"))


@query("log10_floor", with_clause("ranged") + """SELECT trait, final,
    CASE WHEN final = 0 THEN log10(1e-10) WHEN final > 0 THEN log10(final) ELSE 'NaN'::DOUBLE END AS log_x,
    count(*) AS n FROM ranged GROUP BY ALL""")
def q_log10_floor(spark, d):
    return ranged(spark, d).groupBy("trait", "final", X.log10_floor("final").alias("log_x")) \
        .agg(F.count("*").alias("n"))


@query("filter_in_range", with_clause("ranged") + """SELECT trait, count(*) AS n FROM ranged
    WHERE range_position = 'ok' GROUP BY trait""")
def q_filter_in_range(spark, d):
    return FL.filter_in_range(ranged(spark, d)).groupBy("trait").agg(F.count("*").alias("n"))


@query("filter_null_units", with_clause("readings") + """SELECT original_term, count(*) AS n FROM readings
    WHERE result_value_units IS NOT NULL GROUP BY original_term""")
def q_filter_null_units(spark, d):
    return FL.filter_null_units(B.readings(spark, d)).groupBy("original_term").agg(F.count("*").alias("n"))


@query("filter_not_null_all", with_clause("readings") + """SELECT pseudo_nhs_number, test_date, original_term,
    result, result_value_units FROM readings WHERE result_value_units IS NOT NULL AND test_date IS NOT NULL
    AND result IS NOT NULL""")
def q_filter_not_null_all(spark, d):
    r = FL.filter_not_null_all(B.readings(spark, d), ["result_value_units", "test_date", "result"])
    return r.select("pseudo_nhs_number", "test_date", "original_term", "result", "result_value_units")


@query("unrecovered_terms", with_clause("dense", "aliases_d") + """SELECT trait AS original_term, count(*) AS n
    FROM dense WHERE regexp_replace(trait, '^\\s+|\\s+$', '', 'g') NOT IN (SELECT alias FROM aliases_d)
    GROUP BY trait""")
def q_unrecovered_terms(spark, d):
    ev = B.dense_readings(spark, d).select(F.col("trait").alias("original_term"))
    return TR.unrecovered_terms(ev, B.aliases(spark))


@query("units_counts", with_clause("readings") + """SELECT original_term, result_value_units, count(*) AS n
    FROM (SELECT DISTINCT pseudo_nhs_number, original_term, result_value_units FROM readings) x GROUP BY ALL""")
def q_units_counts(spark, d):
    return TR.units_counts(B.readings(spark, d))


@query("provenance_counts", with_clause("readings") + """SELECT provenance, count(*) AS n FROM readings
    GROUP BY provenance""")
def q_provenance_counts(spark, d):
    return TR.provenance_counts(B.readings(spark, d))


# --- people ---------------------------------------------------------------------------------

@query("join_valid_people_semi", with_clause("ranged", "valid_ids") + """SELECT trait, count(*) AS n,
    count(DISTINCT pseudo_nhs_number) AS n_people FROM ranged r
    WHERE pseudo_nhs_number IN (SELECT pseudo_nhs_number FROM valid_ids) GROUP BY trait""")
def q_join_valid_people_semi(spark, d):
    x = PE.join_valid_people_semi(ranged(spark, d), PE.valid_pseudo_nhs_numbers(B.linkage(spark, d)))
    return x.groupBy("trait").agg(F.count("*").alias("n"), F.countDistinct("pseudo_nhs_number").alias("n_people"))


@query("load_demographics", with_clause("valid_demo") + "SELECT pseudo_nhs_number, OrageneID, dob, gender FROM valid_demo")
def q_load_demographics(spark, d):
    return PE.valid_demographics(B.linkage(spark, d), PE.questionnaire_demographics(B.questionnaire(spark, d)))


@query("month_year_to_dob", with_clause("quest") + """SELECT OrageneID,
    CAST(strptime('01-' || mmyyyy, '%d-%m-%Y') AS DATE) AS dob,
    year(CAST(strptime('01-' || mmyyyy, '%d-%m-%Y') AS DATE)) AS year_of_birth FROM quest WHERE mmyyyy <> 'NA'""")
def q_month_year_to_dob(spark, d):
    q = B.questionnaire(spark, d).filter(F.col("S1QST_MM-YYYY_ofBirth") != "NA")
    dob = X.month_year_to_dob(F.col("S1QST_MM-YYYY_ofBirth"))
    return q.select(F.col("S1QST_Oragene_ID").alias("OrageneID"), dob.alias("dob"), F.year(dob).alias("year_of_birth"))


@query("map_strict", with_clause("quest") + """SELECT OrageneID, CASE gcode WHEN '1' THEN 'M' WHEN '2' THEN 'F'
    END AS gender FROM quest""")
def q_map_strict(spark, d):
    q = B.questionnaire(spark, d)
    return q.select(F.col("S1QST_Oragene_ID").alias("OrageneID"),
                    X.map_strict(F.col("S1QST_Gender"), S.GENDER_CODES, "gender").alias("gender"))


@query("join_demographics", with_clause("with_demo") + """SELECT pseudo_nhs_number, test_date, trait, final,
    OrageneID, dob, gender, age_at_test FROM with_demo""")
def q_join_demographics(spark, d):
    x = PE.join_valid_people_semi(ranged(spark, d), PE.valid_pseudo_nhs_numbers(B.linkage(spark, d)))
    demo = PE.valid_demographics(B.linkage(spark, d), PE.questionnaire_demographics(B.questionnaire(spark, d)))
    return PE.join_demographics(x, demo).select("pseudo_nhs_number", "test_date", "trait", "final", "OrageneID",
                                                "dob", "gender", "age_at_test")


@query("age_at_test", with_clause("with_demo") + """SELECT pseudo_nhs_number, test_date, dob,
    age_at_test FROM with_demo""")
def q_age_at_test(spark, d):
    x = q_join_demographics(spark, d)
    return x.select("pseudo_nhs_number", "test_date", "dob", X.age_at_test("test_date", "dob").alias("age_at_test"))


@query("filter_plausible_dates", with_clause("with_demo") + f"""SELECT trait, count(*) AS n FROM with_demo
    WHERE age_at_test >= 0 AND test_date <= {"DATE '" + B.AS_OF + "'"} GROUP BY trait""")
def q_filter_plausible_dates(spark, d):
    x = FL.filter_plausible_dates(q_join_demographics(spark, d), B.AS_OF)
    return x.groupBy("trait").agg(F.count("*").alias("n"))


@query("filter_min_age", with_clause("with_demo") + """SELECT trait, count(*) AS n FROM with_demo
    WHERE age_at_test >= 16 GROUP BY trait""")
def q_filter_min_age(spark, d):
    return FL.filter_min_age(q_join_demographics(spark, d)).groupBy("trait").agg(F.count("*").alias("n"))


@query("join_genotype_ids", with_clause("gsa_ids") + "SELECT pseudo_nhs_number, IID FROM gsa_ids")
def q_join_genotype_ids(spark, d):
    return PE.genotype_ids(B.linkage(spark, d), "gsa")


@query("join_genotype_ids_exome", with_clause("exome_ids") + "SELECT pseudo_nhs_number, IID FROM exome_ids")
def q_join_genotype_ids_exome(spark, d):
    return PE.genotype_ids(B.linkage(spark, d), "exome")


@query("dedup_subset", with_clause("people") + "SELECT pseudo_nhs_number, OrageneID FROM people")
def q_dedup_subset(spark, d):
    lk = B.linkage(spark, d).select("pseudo_nhs_number", "OrageneID").filter(F.col("pseudo_nhs_number").isNotNull())
    return DD.dedup_subset(lk, ["pseudo_nhs_number"], ["OrageneID"])


# --- tiles and outputs ----------------------------------------------------------------------

@query("tile_dedup_11d", with_clause("dense") + """SELECT pseudo_nhs_number, trait, final AS value,
    min(test_date) AS date FROM dense WHERE final IS NOT NULL
    GROUP BY pseudo_nhs_number, trait, final, floor(date_diff('day', DATE '1970-01-01', test_date) / 11.0)""")
def q_tile_dedup_11d(spark, d):
    return TI.tile_dedup_11d(B.dense_readings(spark, d), dependent=())


@query("first_in_tile", with_clause("tiles") + """SELECT pseudo_nhs_number, trait, value, w.d AS date
    FROM tiles""")
def q_first_in_tile(spark, d):
    return TI.tile_dedup_11d(pre_tiling(spark, d)).select("pseudo_nhs_number", "trait", "value", "date")


@query("per_individual_stats", with_clause("tiled_set") + """SELECT setting, pseudo_nhs_number, trait,
    median(value) AS median, round(avg(value), 9) AS mean, max(value) AS max, min(value) AS min,
    min({'d': date, 'v': value}).v AS earliest, max({'d': date, 'v': value}).v AS latest, count(value) AS n
    FROM tiled_set GROUP BY setting, pseudo_nhs_number, trait, minmax_outlier""")
def q_per_individual_stats(spark, d):
    s = ST.per_individual_stats(tiled_settings(spark, d), extra_keys=("setting",))
    return s.withColumn("mean", X.round_half_away("mean", 9))


@query("trait_study_summary", with_clause("tiled_set") + """SELECT setting, trait, median(value) AS median,
    round(avg(value), 9) AS mean, min(value) AS min, max(value) AS max,
    count(DISTINCT pseudo_nhs_number) AS n_people, count(*) AS n_obs, min(unit) AS unit
    FROM tiled_set GROUP BY setting, trait""")
def q_trait_study_summary(spark, d):
    return ST.trait_study_summary(tiled_settings(spark, d)).withColumn("mean", X.round_half_away("mean", 9))


@query("trait_summary_from_sketches", with_clause("tiled_set") + """SELECT setting, trait, median(value) AS median,
    round(avg(value), 9) AS mean, min(value) AS min, max(value) AS max,
    count(DISTINCT pseudo_nhs_number) AS n_people, count(*) AS n FROM tiled_set GROUP BY setting, trait""")
def q_trait_summary_from_sketches(spark, d):
    """Four releases sketched one by one; the summary comes from the merged sketches and one pass inside the medians' brackets."""
    readings = tiled_settings(spark, d)
    part = F.pmod(F.xxhash64("pseudo_nhs_number"), F.lit(4))
    merged = staged(spark, f"value-sketches:{d}", lambda: SE.merged_values(DD.union_sources(
        [SE.value_sketches(readings.filter(part == k)) for k in range(4)])), fingerprint(spark, d))
    return SE.summary(merged, SE.exact_medians(readings, merged)).withColumn("mean", X.round_half_away("mean", 9))


@query("trait_log10_histogram", with_clause("tiled_set") + """, L AS (SELECT setting, trait, gender,
      CASE WHEN value = 0 THEN log10(1e-10) WHEN value > 0 THEN log10(value) ELSE 'NaN'::DOUBLE END AS log_x
      FROM tiled_set WHERE trait IS NOT NULL),
    Bd AS (SELECT setting, trait, min(log_x) AS lo, max(log_x) AS hi FROM L GROUP BY ALL),
    X AS (SELECT L.setting, L.trait, L.gender, lo, hi, (hi - lo) / 48.0 AS w,
      CAST(CASE WHEN (hi - lo) / 48.0 > 0 THEN least(floor((log_x - lo) / ((hi - lo) / 48.0)), 47) ELSE 0 END
           AS INTEGER) AS bin FROM L JOIN Bd ON L.setting = Bd.setting AND L.trait = Bd.trait)
    SELECT setting, trait, gender, bin, round(lo + bin * w, 9) AS bin_start, round(lo + (bin + 1) * w, 9) AS bin_end,
      count(*) AS n FROM X GROUP BY setting, trait, gender, bin, lo, w""")
def q_trait_log10_histogram(spark, d):
    h = ST.trait_log10_histogram(tiled_settings(spark, d))
    return h.withColumn("bin_start", X.round_half_away("bin_start", 9)).withColumn("bin_end", X.round_half_away("bin_end", 9))


@query("phenotype_table", with_clause("tiled_set", "gsa_ids") + """SELECT setting, trait, '1' AS FID, g.IID,
    median(value) AS median, min(value) AS min, max(value) AS max
    FROM tiled_set t JOIN gsa_ids g ON t.pseudo_nhs_number = g.pseudo_nhs_number GROUP BY setting, trait, g.IID""")
def q_phenotype_table(spark, d):
    return ST.phenotype_table(tiled_settings(spark, d), PE.genotype_ids(B.linkage(spark, d), "gsa"))


@query("phenotype_table_exome", with_clause("tiled_set", "exome_ids") + """SELECT setting, trait, '1' AS FID,
    g.IID, median(value) AS median, min(value) AS min, max(value) AS max
    FROM tiled_set t JOIN exome_ids g ON t.pseudo_nhs_number = g.pseudo_nhs_number GROUP BY setting, trait, g.IID""")
def q_phenotype_table_exome(spark, d):
    return ST.phenotype_table(tiled_settings(spark, d), PE.genotype_ids(B.linkage(spark, d), "exome"))


def _traits_in_data() -> list[str]:
    """Traits of the fixed dictionary that have aliases (so occur in the bound readings)."""
    return sorted({t for t, _ in B.ALIASES})


def _megawide_sql(ids: str) -> str:
    traits = _traits_in_data()
    stat_sql = {"min": "min({c})", "median": "median({c})", "max": "max({c})"}
    cols = []
    for t in traits:
        for stat in ["min", "median", "max"]:
            for base in ["AgeAtTest", "AgeAtTest_Squared"]:
                cols.append(f"round(max(CASE WHEN trait = '{t}' THEN {base}_{stat} END), 1) AS \"{base}.{t}.{stat}\"")
    inner = ", ".join(f"{stat_sql[s].format(c=b)} AS {b}_{s}" for s in ["min", "median", "max"]
                      for b in ["AgeAtTest", "AgeAtTest_Squared"])
    return with_clause("tiled_set", ids) + f"""SELECT setting, '1' AS FID, IID, {", ".join(cols)} FROM (
      SELECT setting, IID, trait, {inner} FROM (
        SELECT setting, g.IID, trait, round(age_at_test, 1) AS AgeAtTest,
               round(pow(age_at_test, 2), 1) AS AgeAtTest_Squared
        FROM tiled_set t JOIN {ids} g ON t.pseudo_nhs_number = g.pseudo_nhs_number) x
      GROUP BY setting, IID, trait) y GROUP BY setting, IID"""


@query("covariate_megawide", _megawide_sql("gsa_ids"))
def q_covariate_megawide(spark, d):
    return ST.covariate_megawide(tiled_settings(spark, d), PE.genotype_ids(B.linkage(spark, d), "gsa"))


@query("covariate_megawide_exome", _megawide_sql("exome_ids"))
def q_covariate_megawide_exome(spark, d):
    return ST.covariate_megawide(tiled_settings(spark, d), PE.genotype_ids(B.linkage(spark, d), "exome"))


@query("power_round", with_clause("pre") + """SELECT pseudo_nhs_number, test_date, trait,
    round(pow(age_at_test, 2), 1) AS age_squared FROM pre""")
def q_power_round(spark, d):
    return pre_tiling(spark, d).select("pseudo_nhs_number", "test_date", "trait",
                                       X.power_round("age_at_test", 2, 1).alias("age_squared"))


# --- messy result text (scalars and filters) ------------------------------------------------

NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TEXT_SQL = with_clause("readings") + """, T AS (SELECT l_orderkey, l_linenumber, original_term, result_value_units,
    test_date, pseudo_nhs_number, q,
    CASE l_orderkey % 10 WHEN 0 THEN '<' || q WHEN 1 THEN '>' || q WHEN 2 THEN 'Less than ' || q
      WHEN 3 THEN ' ' || q WHEN 4 THEN 'NA' WHEN 5 THEN '{' || q || '}' WHEN 6 THEN q || '%'
      WHEN 7 THEN q || 'cm' WHEN 8 THEN q ELSE '.' END AS text,
    CASE WHEN l_linenumber % 3 = 0 THEN '1,' || q ELSE q END AS text2,
    q || '.1' AS typo
  FROM (SELECT *, CAST(CAST(result AS BIGINT) AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS q
        FROM readings) r)
"""


def readings_text(spark, d):
    li = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
                                              "l_linestatus")
    q = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))
    k = F.col("l_orderkey") % 10
    text = (F.when(k == 0, F.concat(F.lit("<"), q)).when(k == 1, F.concat(F.lit(">"), q))
            .when(k == 2, F.concat(F.lit("Less than "), q)).when(k == 3, F.concat(F.lit(" "), q))
            .when(k == 4, F.lit("NA")).when(k == 5, F.concat(F.lit("{"), q, F.lit("}")))
            .when(k == 6, F.concat(q, F.lit("%"))).when(k == 7, F.concat(q, F.lit("cm")))
            .when(k == 8, q).otherwise(F.lit(".")))
    return li.select("l_orderkey", "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("original_term"),
                     q.alias("q"), text.alias("text"),
                     F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("1,"), q)).otherwise(q).alias("text2"),
                     F.concat(q, F.lit(".1")).alias("typo"))


def _sql_num(expr):
    return f"CASE WHEN regexp_matches({expr}, '{NUM_RE}') THEN CAST({expr} AS DOUBLE) END"


@query("parse_number_lenient", TEXT_SQL + f"SELECT l_orderkey, l_linenumber, text, {_sql_num('text')} AS result FROM T")
def q_parse_number_lenient(spark, d):
    t = readings_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", "text", X.parse_number_lenient("text").alias("result"))


@query("parse_number_strict", TEXT_SQL + "SELECT l_orderkey, l_linenumber, CAST(q AS DOUBLE) AS result FROM T")
def q_parse_number_strict(spark, d):
    t = readings_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", X.parse_number_strict("q").alias("result"))


PREFIXES = ["<", ">", "Less than ", " "]
SUFFIXES = ["%", "cm"]


@query("strip_prefix_chain", TEXT_SQL + """SELECT l_orderkey, l_linenumber, s, """ + _sql_num("s") + """ AS result
    FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '^<', ''), '^>', ''),
      '^Less than ', ''), '^ ', '') AS s FROM T) x""")
def q_strip_prefix_chain(spark, d):
    t = readings_text(spark, d).withColumn("s", X.strip_prefix_chain("text", PREFIXES))
    return t.select("l_orderkey", "l_linenumber", "s", X.parse_number_lenient("s").alias("result"))


@query("strip_suffix_chain", TEXT_SQL + """SELECT l_orderkey, l_linenumber,
    regexp_replace(regexp_replace(text, '%$', ''), 'cm$', '') AS s FROM T""")
def q_strip_suffix_chain(spark, d):
    t = readings_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", X.strip_suffix_chain("text", SUFFIXES).alias("s"))


@query("unwrap_brackets", TEXT_SQL + r"""SELECT l_orderkey, l_linenumber, regexp_replace(regexp_replace(
    regexp_replace(text, '^\{(.*?)\}$', '\1'), '^\((.*?)\)$', '\1'), '^\*\{(.*?)\}$', '\1') AS s FROM T""")
def q_unwrap_brackets(spark, d):
    t = readings_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", X.unwrap_brackets("text").alias("s"))


@query("replace_first", TEXT_SQL + "SELECT l_orderkey, l_linenumber, regexp_replace(text, '[0-9]', '#') AS s FROM T")
def q_replace_first(spark, d):
    t = readings_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", X.replace_first("text", "[0-9]", "#").alias("s"))


@query("replace_all_literal", TEXT_SQL + "SELECT l_orderkey, l_linenumber, replace(text, '.', '') AS s FROM T")
def q_replace_all_literal(spark, d):
    t = readings_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", X.replace_all_literal("text", ".").alias("s"))


@query("strip_chars", TEXT_SQL + r"""SELECT l_orderkey, l_linenumber,
    regexp_replace(text, '^\s+|\s+$', '', 'g') AS s FROM T""")
def q_strip_chars(spark, d):
    t = readings_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", X.strip_chars("text").alias("s"))


@query("filter_literal_blocklist", TEXT_SQL + """SELECT text, count(*) AS n FROM T
    WHERE text NOT IN ('NA', '.') GROUP BY text""")
def q_filter_literal_blocklist(spark, d):
    return FL.filter_literal_blocklist(readings_text(spark, d), "text", ["NA", "."]) \
        .groupBy("text").agg(F.count("*").alias("n"))


@query("filter_in_blocklist", TEXT_SQL + """SELECT original_term, count(*) AS n FROM T
    WHERE original_term NOT IN ('AF', 'RO') GROUP BY original_term""")
def q_filter_in_blocklist(spark, d):
    return FL.filter_in_blocklist(readings_text(spark, d), "original_term", ["AF", "RO"]) \
        .groupBy("original_term").agg(F.count("*").alias("n"))


REGEX_BLOCK = ["(?i)less than", "[a-zA-Z]", "%", r"^\{"]


@query("filter_regex_blocklist", TEXT_SQL + r"""SELECT l_orderkey, l_linenumber, text FROM T
    WHERE NOT regexp_matches(text, '(?i)less than') AND NOT regexp_matches(text, '[a-zA-Z]')
      AND NOT regexp_matches(text, '%') AND NOT regexp_matches(text, '^\{')""")
def q_filter_regex_blocklist(spark, d):
    t = FL.filter_regex_blocklist(readings_text(spark, d), "text", REGEX_BLOCK)
    return t.select("l_orderkey", "l_linenumber", "text")


@query("filter_prefix_suffix", TEXT_SQL + """SELECT l_orderkey, l_linenumber, text FROM T
    WHERE NOT starts_with(text, ' ') AND NOT ends_with(text, 'cm')""")
def q_filter_prefix_suffix(spark, d):
    t = FL.filter_prefix_suffix(readings_text(spark, d), "text", [" "], ["cm"])
    return t.select("l_orderkey", "l_linenumber", "text")


@query("filter_regex_allowlist", TEXT_SQL + r"""SELECT l_orderkey, l_linenumber, text FROM T
    WHERE regexp_matches(text, '^\d+\.\d+$')""")
def q_filter_regex_allowlist(spark, d):
    t = FL.filter_regex_allowlist(readings_text(spark, d), "text", r"^\d+\.\d+$")
    return t.select("l_orderkey", "l_linenumber", "text")


@query("filter_not_nan", TEXT_SQL + f"""SELECT l_orderkey, l_linenumber, result FROM
    (SELECT *, {_sql_num('text')} AS result FROM T) x WHERE result IS NOT NULL AND NOT isnan(result)""")
def q_filter_not_nan(spark, d):
    t = readings_text(spark, d).withColumn("result", X.parse_number_lenient("text"))
    return FL.filter_not_nan(t, "result").select("l_orderkey", "l_linenumber", "result")


@query("filter_nonempty", TEXT_SQL + r"""SELECT l_orderkey, l_linenumber, s FROM
    (SELECT *, regexp_replace(text, '\.$', '') AS s FROM T) x WHERE s <> ''""")
def q_filter_nonempty(spark, d):
    t = readings_text(spark, d).withColumn("s", X.strip_suffix("text", "."))
    return FL.filter_nonempty(t, "s").select("l_orderkey", "l_linenumber", "s")


@query("conditional_value_repair", TEXT_SQL + """SELECT l_orderkey, l_linenumber, original_term,
    CASE WHEN original_term = 'AF' THEN replace(text2, ',', '') ELSE text2 END AS text2 FROM T""")
def q_conditional_value_repair(spark, d):
    t = FL.conditional_value_repair(readings_text(spark, d), "text2", "original_term", "AF")
    return t.select("l_orderkey", "l_linenumber", "original_term", "text2")


@query("typo_repair", TEXT_SQL + r"""SELECT l_orderkey, l_linenumber,
    regexp_replace(typo, '3\.6\.1', '36.1') AS typo FROM T""")
def q_typo_repair(spark, d):
    return FL.typo_repair(readings_text(spark, d), "typo").select("l_orderkey", "l_linenumber", "typo")


@query("impute_unit_from_term", """SELECT p_partkey, p_name, CASE WHEN regexp_matches(p_name, '(?i)green') THEN 'kg'
    WHEN regexp_matches(p_name, '(?i)blue') THEN 'cm' WHEN regexp_matches(p_name, '(?i)red') THEN 'mmHg' END
    AS result_value_units FROM part""")
def q_impute_unit_from_term(spark, d):
    p = B.table(spark, d, "part").select("p_partkey", "p_name")
    return FL.impute_unit_from_term(p, "p_name", [("green", "kg"), ("blue", "cm"), ("red", "mmHg")])


@query("impute_unit_for_term", with_clause("readings") + """SELECT pseudo_nhs_number, test_date, original_term,
    result, CASE WHEN original_term = 'RF' AND result_value_units IS NULL THEN 'millimol/L'
    ELSE result_value_units END AS result_value_units FROM readings""")
def q_impute_unit_for_term(spark, d):
    r = FL.impute_unit_for_term(B.readings(spark, d), "RF", "millimol/L")
    return r.select("pseudo_nhs_number", "test_date", "original_term", "result", "result_value_units")


@query("coalesce_columns", with_clause("readings") + """SELECT original_term,
    coalesce(result_value_units, 'none') AS unit, count(*) AS n FROM readings GROUP BY ALL""")
def q_coalesce_columns(spark, d):
    r = B.readings(spark, d)
    return r.groupBy("original_term", X.coalesce_columns("result_value_units", F.lit("none")).alias("unit")) \
        .agg(F.count("*").alias("n"))


@query("row_hash", with_clause("readings") + """SELECT count(DISTINCT {'p': pseudo_nhs_number, 'd': test_date,
    't': original_term, 'r': result, 'u': result_value_units}) AS n_distinct FROM readings""")
def q_row_hash(spark, d):
    r = B.readings(spark, d).select(X.row_hash(*S.READING_KEY).alias("hash"))
    return r.agg(F.countDistinct("hash").alias("n_distinct"))


@query("file_stem", r"""SELECT page_id, string_split(regexp_replace(url, '\.html$', ''), '/')[-1] AS stem
    FROM pages""")
def q_file_stem(spark, d):
    p = B.table(spark, d, "pages").select("page_id", "url")
    return p.select("page_id", X.file_stem("url", ".html").alias("stem"))


DATE_TEXT_SQL = with_clause("readings") + """, DT AS (SELECT l_orderkey, l_linenumber, iso,
    CASE l_orderkey % 3 WHEN 0 THEN iso WHEN 1 THEN strftime(test_date, '%d/%m/%Y') ELSE iso || ' 10:30' END AS t,
    CASE l_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'garbage' ELSE '4' || substr(iso, 2) || ' 10:00' END AS c1,
    iso || ' 00:00' AS c2
  FROM (SELECT *, strftime(test_date, '%Y-%m-%d') AS iso FROM readings) r)
"""


def date_text(spark, d):
    li = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("dt"))
    iso = F.date_format("dt", "yyyy-MM-dd")
    k3, k4 = F.col("l_orderkey") % 3, F.col("l_orderkey") % 4
    t = (F.when(k3 == 0, iso).when(k3 == 1, F.date_format("dt", "dd/MM/yyyy"))
         .otherwise(F.concat(iso, F.lit(" 10:30"))))
    c1 = (F.when(k4 == 0, F.lit(None).cast("string")).when(k4 == 1, F.lit("garbage"))
          .otherwise(F.concat(F.lit("4"), F.substring(iso, 2, 100), F.lit(" 10:00"))))
    return li.select("l_orderkey", "l_linenumber", iso.alias("iso"), t.alias("t"), c1.alias("c1"),
                     F.concat(iso, F.lit(" 00:00")).alias("c2"))


@query("parse_dates_multi", DATE_TEXT_SQL + """SELECT l_orderkey, l_linenumber, t,
    CAST(coalesce(try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%d/%m/%Y'), try_strptime(t, '%Y-%m-%d %H:%M'))
    AS DATE) AS test_date FROM DT""")
def q_parse_dates_multi(spark, d):
    t = date_text(spark, d)
    parsed = F.coalesce(*[X.parse_date_lenient("t", f) for f in ["yyyy-MM-dd", "dd/MM/yyyy", "yyyy-MM-dd HH:mm"]])
    return t.select("l_orderkey", "l_linenumber", "t", parsed.alias("test_date"))


@query("first_valid_date", DATE_TEXT_SQL + """SELECT l_orderkey, l_linenumber, CAST(coalesce(
    try_strptime(c1, '%Y-%m-%d %H:%M'), try_strptime(c2, '%Y-%m-%d %H:%M')) AS DATE) AS test_date FROM DT""")
def q_first_valid_date(spark, d):
    t = date_text(spark, d)
    return t.select("l_orderkey", "l_linenumber", X.first_valid_date(["c1", "c2"]).alias("test_date"))


# --- pulls, unions and dedup ----------------------------------------------------------------

PULLS = [("pull_a", (0, 1)), ("pull_b", (1, 2)), ("pull_c", (2, 3)), ("pull_d", (3, 0))]
PULL_SQL = with_clause("readings") + ", PULLS AS (" + " UNION ALL ".join(
    f"""SELECT pseudo_nhs_number, test_date, original_term, result, result_value_units, '{p}' AS provenance,
        source, {i + 1} AS rk FROM readings WHERE l_suppkey % 4 IN {r}""" for i, (p, r) in enumerate(PULLS)) + ")\n"


def pulls(spark, d):
    """Four overlapping pulls of the readings (by supplier residue), each tagged as its own source."""
    r = B.readings(spark, d)
    return [r.filter(F.col("provenance").isin(*[f"pull_{'abcd'[k]}" for k in ks])).withColumn("provenance", F.lit(p))
            for p, ks in PULLS]


@query("union_sources", PULL_SQL + "SELECT provenance, count(*) AS n FROM PULLS GROUP BY provenance")
def q_union_sources(spark, d):
    return DD.union_sources(pulls(spark, d)).groupBy("provenance").agg(F.count("*").alias("n"))


DEDUP_SQL = """SELECT pseudo_nhs_number, test_date, original_term, result, result_value_units,
    min({'r': rk, 'p': provenance, 's': source}).p AS provenance, min({'r': rk, 'p': provenance, 's': source}).s AS source
    FROM PULLS {where} GROUP BY pseudo_nhs_number, test_date, original_term, result, result_value_units"""


@query("dedup_readings", PULL_SQL + DEDUP_SQL.replace("{where}", ""))
def q_dedup_readings(spark, d):
    return DD.dedup_readings(DD.union_sources(pulls(spark, d)), B.PROVENANCE_ORDER)


@query("merge_primary", PULL_SQL + DEDUP_SQL.replace("{where}", "WHERE provenance IN ('pull_a', 'pull_b')"))
def q_merge_primary(spark, d):
    p = pulls(spark, d)
    return DD.merge(p[:2], B.PROVENANCE_ORDER)


@query("merge_secondary", PULL_SQL + DEDUP_SQL.replace("{where}", "WHERE provenance IN ('pull_c', 'pull_d')"))
def q_merge_secondary(spark, d):
    p = pulls(spark, d)
    return DD.merge(p[2:], B.PROVENANCE_ORDER)


@query("merge_all_sources", PULL_SQL + DEDUP_SQL.replace("{where}", ""))
def q_merge_all_sources(spark, d):
    p = pulls(spark, d)
    primary, secondary = DD.merge(p[:2], B.PROVENANCE_ORDER), DD.merge(p[2:], B.PROVENANCE_ORDER)
    return DD.merge([primary, secondary], B.PROVENANCE_ORDER)


@query("merge_incremental", PULL_SQL + DEDUP_SQL.replace("{where}", ""))
def q_merge_incremental(spark, d):
    """The pulls added one after another, the last one first, to a stored combo; only the pull at hand is shuffled."""
    store = CO.ComboStore(spark, staging_path(spark, "combo-store"), B.PROVENANCE_ORDER, buckets=16)
    for pull in reversed(pulls(spark, d)):
        store.add(pull)
    return store.read()


@query("merge_incremental_missing", PULL_SQL + """SELECT pseudo_nhs_number, test_date, original_term, result, result_value_units, min(rk) AS rk
    FROM PULLS WHERE rk = 3 AND (pseudo_nhs_number, test_date, original_term, result, coalesce(result_value_units, '-')) NOT IN (
      SELECT (pseudo_nhs_number, test_date, original_term, result, coalesce(result_value_units, '-')) FROM PULLS WHERE rk < 3)
    GROUP BY ALL""")
def q_merge_incremental_missing(spark, d):
    """What the third pull brings to a store of the first two."""
    store = CO.ComboStore(spark, staging_path(spark, "combo-store"), B.PROVENANCE_ORDER, buckets=16)
    first, second, third, _ = pulls(spark, d)
    for pull in (first, second):
        store.add(pull)
    new = DD.named(store.missing(third), B.PROVENANCE_ORDER)
    return new.select(*S.READING_KEY, F.array_position(F.array(*[F.lit(p) for p in B.PROVENANCE_ORDER]), F.col("provenance")).alias("rk"))


@query("tag_provenance", with_clause("readings") + """SELECT pseudo_nhs_number, test_date, original_term, result,
    result_value_units, 'pull_x' AS provenance, 'secondary_care' AS source FROM readings""")
def q_tag_provenance(spark, d):
    r = B.readings(spark, d).drop("provenance", "source")
    return FL.canonical_select(FL.tag_provenance(r, "pull_x", "secondary_care"))


@query("canonical_select", """SELECT 'P' || CAST(o_custkey AS VARCHAR) AS pseudo_nhs_number,
    CAST(l_shipdate AS DATE) AS test_date, l_returnflag AS original_term, l_quantity AS result,
    l_linestatus AS result_value_units, 'raw' AS provenance, 'primary_care' AS source
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def q_canonical_select(spark, d):
    li = B.table(spark, d, "lineitem")
    od = B.table(spark, d, "orders")
    raw = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("STUDY_ID"), "l_shipdate", "l_returnflag",
        "l_quantity", "l_linestatus")
    raw = FL.tag_provenance(raw.withColumn("l_shipdate", F.col("l_shipdate").cast("date")), "raw", "primary_care")
    return FL.canonical_select(raw, {"STUDY_ID": "pseudo_nhs_number", "l_shipdate": "test_date",
                                     "l_returnflag": "original_term", "l_quantity": "result",
                                     "l_linestatus": "result_value_units"})


@query("sort_stays", with_clause("stays") + """SELECT pseudo_nhs_number, adm, dis,
    row_number() OVER (PARTITION BY pseudo_nhs_number ORDER BY adm, dis DESC NULLS LAST) AS place FROM stays""")
def q_sort_stays(spark, d):
    """Stays in order, with their place in the person's order."""
    st = B.stays(spark, d).select("pseudo_nhs_number", F.col("hospital_admission_datetime").alias("adm"),
                                  F.col("hospital_discharge_datetime").alias("dis"))
    order = [F.col("adm").asc(), F.col("dis").desc_nulls_last()]
    return (st.withColumn("place", F.row_number().over(Window.partitionBy("pseudo_nhs_number").orderBy(*order)).cast("long"))
            .orderBy("pseudo_nhs_number", "place"))


@query("sort_desc_counts", with_clause("readings") + """SELECT original_term, result_value_units, n,
    row_number() OVER (ORDER BY n DESC, original_term, result_value_units NULLS FIRST) AS place FROM (
      SELECT original_term, result_value_units, count(*) AS n
      FROM (SELECT DISTINCT pseudo_nhs_number, original_term, result_value_units FROM readings) x GROUP BY ALL) y""")
def q_sort_desc_counts(spark, d):
    """The count table (one row per term and unit) in descending order, with the place in it."""
    order = [F.desc("n"), F.asc_nulls_first("original_term"), F.asc_nulls_first("result_value_units")]
    return TR.units_counts(B.readings(spark, d)).withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))


# --- reshaping ------------------------------------------------------------------------------

@query("unpivot_bp", """SELECT pseudo_nhs_number, test_date, original_term, result, 'mmHg' AS result_value_units
    FROM (SELECT 'P' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS pseudo_nhs_number,
                 CAST(l_shipdate AS DATE) AS test_date, l_quantity + 50 AS dia, l_quantity + 90 AS sys FROM lineitem) x
    UNPIVOT (result FOR original_term IN (dia AS 'Diastolic arterial pressure', sys AS 'Systolic arterial pressure'))
    WHERE result IS NOT NULL""")
def q_unpivot_bp(spark, d):
    li = B.table(spark, d, "lineitem")
    nda = li.select(F.concat(F.lit("P"), F.col("l_orderkey").cast("string"), F.lit("-"),
                             F.col("l_linenumber").cast("string")).alias("STUDY_ID"),
                    F.col("l_shipdate").cast("date").alias("BP_Date"),
                    (F.col("l_quantity") + 50).alias("DIASTOLIC_VALUE"),
                    (F.col("l_quantity") + 90).alias("SYSTOLIC_VALUE"))
    from traitflow.sources.ingest import unpivot_bp
    return unpivot_bp(nda, "STUDY_ID", "BP_Date")


@query("unpivot_boundaries", with_clause("iv1") + """SELECT DISTINCT id, x FROM (SELECT id, s AS x FROM iv1
    UNION ALL SELECT id, e FROM iv1) u WHERE x IS NOT NULL""")
def q_unpivot_boundaries(spark, d):
    st = B.stays(spark, d)
    b = IV.boundaries(st, "pseudo_nhs_number", "hospital_admission_datetime", "hospital_discharge_datetime")
    return b.select(F.col("pseudo_nhs_number").alias("id"), F.col("boundary").alias("x"))


@query("next_boundary", with_clause("m1_seg") + "SELECT id, s, e FROM m1_seg WHERE e IS NOT NULL")
def q_next_boundary(spark, d):
    st = B.stays(spark, d)
    s = IV.elementary_segments(st, "pseudo_nhs_number", "hospital_admission_datetime", "hospital_discharge_datetime")
    return s.select(F.col("pseudo_nhs_number").alias("id"), F.col("hospital_admission_datetime").alias("s"),
                    F.col("hospital_discharge_datetime").alias("e"))


# --- audit and checks -----------------------------------------------------------------------

@query("audit_row_counts", with_clause("with_demo") + f"""SELECT step, label, before, after,
    CASE WHEN before > 0 THEN round((after - before) * 100.0 / before, 1) END AS pct_change FROM (
    SELECT 1 AS step, 'range_ok' AS label, count(*) AS before,
           CAST(sum(CASE WHEN coalesce(range_position = 'ok', false) THEN 1 ELSE 0 END) AS BIGINT) AS after FROM with_demo
    UNION ALL SELECT 2, 'plausible_dates',
           CAST(sum(CASE WHEN coalesce(range_position = 'ok', false) THEN 1 ELSE 0 END) AS BIGINT),
           CAST(sum(CASE WHEN coalesce(range_position = 'ok', false) AND coalesce(age_at_test >= 0 AND
             test_date <= {"DATE '" + B.AS_OF + "'"}, false) THEN 1 ELSE 0 END) AS BIGINT) FROM with_demo
    UNION ALL SELECT 3, 'min_age',
           CAST(sum(CASE WHEN coalesce(range_position = 'ok', false) AND coalesce(age_at_test >= 0 AND
             test_date <= {"DATE '" + B.AS_OF + "'"}, false) THEN 1 ELSE 0 END) AS BIGINT),
           CAST(sum(CASE WHEN coalesce(range_position = 'ok', false) AND coalesce(age_at_test >= 0 AND
             test_date <= {"DATE '" + B.AS_OF + "'"}, false) AND coalesce(age_at_test >= 16, false)
             THEN 1 ELSE 0 END) AS BIGINT) FROM with_demo) x""")
def q_audit_row_counts(spark, d):
    demo = PE.valid_demographics(B.linkage(spark, d), PE.questionnaire_demographics(B.questionnaire(spark, d)))
    wd = PE.join_demographics(PE.join_valid_people_semi(ranged(spark, d),
                                                        PE.valid_pseudo_nhs_numbers(B.linkage(spark, d))), demo)
    return AU.audit_steps(wd, [
        ("range_ok", F.col("range_position") == "ok"),
        ("plausible_dates", (F.col("age_at_test") >= 0) & (F.col("test_date") <= F.lit(B.AS_OF).cast("date"))),
        ("min_age", F.col("age_at_test") >= 16)])


TRACE_SQL = with_clause("readings", "dict_d", "units_d", "valid_demo") + f""", X AS (
    SELECT r.*, d.trait, d."min" AS lo, d."max" AS hi, v.pseudo_nhs_number IS NOT NULL AS known_person, CASE
      WHEN d.trait = 'HbA1c' AND r.result_value_units IN ('%', '% total Hb', '%Hb', 'per cent') THEN 10.93::DOUBLE * r.result + (-23.5)::DOUBLE
      WHEN u.multiplication_factor <> 1 THEN r.result * u.multiplication_factor ELSE r.result END AS final,
      date_diff('day', v.dob, r.test_date)::DOUBLE / 365.25::DOUBLE AS age
    FROM readings r LEFT JOIN dict_d d ON r.original_term = d.alias
    LEFT JOIN units_d u ON r.result_value_units = u.result_value_units AND d.target_units = u.target
    LEFT JOIN valid_demo v ON r.pseudo_nhs_number = v.pseudo_nhs_number),
  T AS (SELECT *, CASE WHEN trait IS NULL THEN 1 WHEN result_value_units IS NULL THEN 2 WHEN NOT known_person THEN 3
      WHEN (final >= lo AND final <= hi) IS NOT TRUE THEN 4
      WHEN (age >= 0 AND test_date <= DATE '{B.AS_OF}') IS NOT TRUE THEN 5 WHEN (age >= 16) IS NOT TRUE THEN 6 ELSE 0 END AS rule FROM X),
  L AS (SELECT * FROM (VALUES (1, 'known_term'), (2, 'has_unit'), (3, 'known_person'), (4, 'range_ok'), (5, 'plausible_dates'), (6, 'min_age')) l(step, label))
"""


def _trace(spark, d):
    return P.traced_readings(B.readings(spark, d), B.traits(spark), B.aliases(spark), B.units(spark), B.linkage(spark, d),
                             B.questionnaire(spark, d), B.AS_OF)


@query("audit_rule_trace", TRACE_SQL + """SELECT pseudo_nhs_number, test_date, original_term, result, result_value_units, provenance,
    trait, rule, label AS reason FROM T JOIN L ON rule = step""")
def q_audit_rule_trace(spark, d):
    """The quarantined readings: each with the first rule that drops it."""
    return AU.quarantine(_trace(spark, d), P.reading_rules(B.AS_OF)).select(
        "pseudo_nhs_number", "test_date", "original_term", "result", "result_value_units", "provenance", "trait", "rule", "reason")


@query("audit_rule_counts", TRACE_SQL + """SELECT step, label, before, after, CASE WHEN before > 0 THEN round((after - before) * 100.0 / before, 1) END AS pct_change
    FROM (SELECT step, label, (SELECT count(*) FROM T WHERE rule = 0 OR rule >= step) AS before,
                 (SELECT count(*) FROM T WHERE rule = 0 OR rule > step) AS after FROM L) x""")
def q_audit_rule_counts(spark, d):
    """Rows before and after each rule, from one aggregation of the trace."""
    rules = P.reading_rules(B.AS_OF)
    return AU.rule_counts(_trace(spark, d), rules)


@query("audit_people_sketches", TRACE_SQL + """SELECT step, label, (SELECT count(DISTINCT pseudo_nhs_number) FROM T WHERE rule = 0 OR rule > step) AS n_people
    FROM (SELECT 0 AS step, 'all' AS label UNION ALL SELECT step, label FROM L) s""")
def q_audit_people_sketches(spark, d):
    """Distinct people after each rule, from theta sketches kept per source and merged (exact up to 65,536 people)."""
    stored = staged(spark, f"people-sketches:{d}", lambda: SE.people_sketches(_trace(spark, d), P.reading_rules(B.AS_OF)), fingerprint(spark, d))
    return SE.people_counts(stored)


@query("audit_source_overlaps", TRACE_SQL + """, S AS (SELECT DISTINCT provenance, pseudo_nhs_number FROM T)
    SELECT a.provenance AS first, b.provenance AS second, count(*) AS n_people FROM S a JOIN S b
    ON a.pseudo_nhs_number = b.pseudo_nhs_number AND a.provenance < b.provenance GROUP BY ALL""")
def q_audit_source_overlaps(spark, d):
    """People that two pulls share, from the stored sketches alone."""
    stored = staged(spark, f"people-sketches:{d}", lambda: SE.people_sketches(_trace(spark, d), P.reading_rules(B.AS_OF)), fingerprint(spark, d))
    return SE.people_overlaps(stored)


@query("audit_unique", with_clause("readings") + """SELECT 'readings' AS label, count(*) AS before,
    count(DISTINCT {'p': pseudo_nhs_number, 'd': test_date, 't': original_term, 'r': result, 'u': result_value_units})
    AS after, round((count(DISTINCT {'p': pseudo_nhs_number, 'd': test_date, 't': original_term, 'r': result,
    'u': result_value_units}) - count(*)) * 100.0 / count(*), 1) AS pct_change FROM readings""")
def q_audit_unique(spark, d):
    return AU.audit_unique(B.readings(spark, d), S.READING_KEY, "readings")


@query("audit_join", with_clause("readings", "valid_demo") + """SELECT 'demographics' AS label, 'left' AS side,
    count(*) AS rows FROM readings UNION ALL SELECT 'demographics', 'right', count(*) FROM valid_demo
    UNION ALL SELECT 'demographics', 'result', count(*) FROM readings r
    LEFT JOIN valid_demo v ON r.pseudo_nhs_number = v.pseudo_nhs_number""")
def q_audit_join(spark, d):
    demo = PE.valid_demographics(B.linkage(spark, d), PE.questionnaire_demographics(B.questionnaire(spark, d)))
    _, counts = AU.audit_join(B.readings(spark, d), demo, "pseudo_nhs_number", "left", "demographics")
    return counts


@query("check_dictionary_unique", PART_DICT + "SELECT alias, count(*) AS n FROM pa GROUP BY alias HAVING count(*) > 1")
def q_check_dictionary_unique(spark, d):
    """The unit key passes; aliases that name several traits break uniqueness and are reported."""
    AU.check_dictionary_unique(B.part_units(spark, d), ["result_value_units", "target"])
    return AU.duplicates(B.part_aliases(spark, d), ["alias"])


@query("check_m1", with_clause("readings", "stays") + """SELECT pseudo_nhs_number, test_date, count(*) AS n FROM (
    SELECT p.pseudo_nhs_number, p.test_date, s.s FROM (SELECT DISTINCT pseudo_nhs_number, test_date FROM readings) p JOIN (
      SELECT pseudo_nhs_number AS id, CAST(adm AS DATE) AS s, CAST(dis AS DATE) + 30 AS e FROM stays WHERE dis IS NOT NULL) s
      ON p.pseudo_nhs_number = s.id AND p.test_date >= s.s AND p.test_date < s.e) x
    GROUP BY ALL HAVING count(*) > 1""")
def q_check_m1(spark, d):
    """Segments pass the check; the stays with 30 days after them, not merged, overlap and break it:
    the dates that meet several are reported."""
    AU.check_m1(RG.region_lookup(B.readings(spark, d), segments(spark, d)), ["pseudo_nhs_number", "test_date"])
    st = B.stays(spark, d).filter(F.col("hospital_discharge_datetime").isNotNull()).select(
        "pseudo_nhs_number", F.col("hospital_admission_datetime").cast("date").alias("start_date"),
        F.date_add(F.col("hospital_discharge_datetime").cast("date"), 30).alias("end_date"), F.array(F.lit("APC")).alias("region_types"))
    return AU.duplicates(RG.region_lookup(B.readings(spark, d), st), ["pseudo_nhs_number", "test_date"])


@query("check_unique_ids", with_clause("linkage") + """SELECT count(OrageneID) AS n,
    count(DISTINCT OrageneID) AS n_distinct FROM linkage""")
def q_check_unique_ids(spark, d):
    lk = B.linkage(spark, d)
    AU.check_unique_ids(lk, "OrageneID")
    return lk.agg(F.count("OrageneID").alias("n"), F.countDistinct("OrageneID").alias("n_distinct"))


@query("check_closed_set", with_clause("readings") + """SELECT provenance, count(*) AS n FROM readings
    WHERE provenance NOT IN ('pull_a', 'pull_b', 'pull_c') GROUP BY provenance""")
def q_check_closed_set(spark, d):
    r = B.readings(spark, d)
    S.check_closed_set(r, "provenance", B.PROVENANCE_ORDER)
    # the readings that break the smaller set
    return r.filter(~F.col("provenance").isin(B.PROVENANCE_ORDER[:3])).groupBy("provenance").agg(F.count("*").alias("n"))


# --- sources: readers, recipes, stays, linkage ---------------------------------------------

from traitflow.plans import extracts as EX  # noqa: E402
from traitflow.sources import dictionaries as DI  # noqa: E402
from traitflow.sources import ingest as IN  # noqa: E402
from traitflow.sources import lines as LN  # noqa: E402
from traitflow.sources import readers as RD  # noqa: E402
from traitflow.sources import recipes as RC  # noqa: E402
from traitflow.sources import sinks as SK  # noqa: E402
from traitflow.session import spread, staging_path  # noqa: E402

Q_SQL = "CAST(CAST(result AS BIGINT) AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR)"


def _combo_sql(where: str, term: str = "original_term", result: str = "result", unit: str = "result_value_units",
               key: str = "", source: str = "secondary_care") -> str:
    return with_clause("readings") + f"""SELECT DISTINCT pseudo_nhs_number, test_date, {term} AS original_term,
    CAST({result} AS DOUBLE) AS result, {unit} AS result_value_units, '{key}' AS provenance, '{source}' AS source
    FROM readings WHERE {where}"""


@query("ingest_primary_care", _combo_sql("result_value_units IS NOT NULL AND l_orderkey % 29 <> 0",
                                         key="2024_12_Discovery_path", source="primary_care"))
def q_ingest_primary_care(spark, d):
    return IN.ingest(spark, RC.primary_care("2024_12_Discovery_path"), EX.primary_care(spark, d))


@query("ingest_nda_bmi", _combo_sql("l_linenumber <> 7", "'Body Mass Index Measured'", unit="'kg/m2'",
                                    key=RC.NDA_KEY, source="primary_care"))
def q_ingest_nda_bmi(spark, d):
    return IN.ingest(spark, RC.nda("BMI"), EX.nda_bmi(spark, d))


@query("ingest_nda_chol", _combo_sql("l_linenumber <> 7", "'Serum total cholesterol level'", unit="'mmol/L'",
                                     key=RC.NDA_KEY, source="primary_care"))
def q_ingest_nda_chol(spark, d):
    return IN.ingest(spark, RC.nda("CHOL"), EX.nda(spark, d, "CHOL"))


@query("ingest_nda_hba1c", _combo_sql("l_linenumber <> 7", "'Haemoglobin A1c level'", unit="'mmol/mol'",
                                      key=RC.NDA_KEY, source="primary_care"))
def q_ingest_nda_hba1c(spark, d):
    return IN.ingest(spark, RC.nda("HBA1C"), EX.nda(spark, d, "HBA1C"))


@query("ingest_nda_bp", with_clause("readings") + f"""SELECT DISTINCT pseudo_nhs_number, test_date, original_term,
    result, 'mmHg' AS result_value_units, '{RC.NDA_KEY}' AS provenance, 'primary_care' AS source FROM (
      SELECT pseudo_nhs_number, test_date, 'Diastolic arterial pressure' AS original_term, result + 50 AS result
      FROM readings WHERE l_linenumber <> 6
      UNION ALL SELECT pseudo_nhs_number, test_date, 'Systolic arterial pressure', result + 90
      FROM readings WHERE l_linenumber <> 6) x""")
def q_ingest_nda_bp(spark, d):
    return IN.ingest(spark, RC.nda_bp(), EX.nda_bp(spark, d))


@query("ingest_bradford_path_2023_05", _combo_sql("l_orderkey % 8 NOT IN (4, 5)", result=Q_SQL,
                                                  key="2023_05_Bradford_path"))
def q_ingest_bradford_path(spark, d):
    return IN.ingest(spark, RC.bradford_path_2023_05(), EX.bradford_path(spark, d))


@query("ingest_barts_path_2022_03", _combo_sql("l_orderkey % 17 <> 0 AND l_orderkey % 6 NOT IN (3, 4)",
                                               result=Q_SQL, key="2022_03_Barts_path"))
def q_ingest_barts_2022_03(spark, d):
    return IN.ingest(spark, RC.barts_path_2022_03(), EX.barts_2022_03(spark, d))


@query("ingest_bradford_meas_2022_06", _combo_sql(
    "true", term="""CASE l_linenumber % 4 WHEN 0 THEN 'Weight Measured' WHEN 1 THEN 'HEIGHT'
      WHEN 2 THEN 'Body Mass Index' ELSE 'Pulse rate' END""", result=Q_SQL,
    unit="CASE l_linenumber % 4 WHEN 0 THEN 'kg' WHEN 1 THEN 'cm' WHEN 2 THEN 'kg/m2' END",
    key="2022_06_Bradford_measurements"))
def q_ingest_bradford_meas(spark, d):
    return IN.ingest(spark, RC.bradford_meas_2022_06(), EX.bradford_meas(spark, d))


@query("ingest_bradford_meas_2024_12", _combo_sql(
    "l_orderkey % 7 NOT IN (1, 2, 3)", term="""CASE l_linenumber % 6 WHEN 0 THEN 'weight' WHEN 1 THEN 'standing height'
      WHEN 2 THEN 'body mass index' WHEN 3 THEN 'blood pressure' WHEN 4 THEN 'glucose (fasting)' ELSE 'Pulse rate' END""", result=Q_SQL,
    unit="""CASE l_linenumber % 6 WHEN 0 THEN 'kg' WHEN 1 THEN 'cm' WHEN 2 THEN 'kg/m^2' WHEN 3 THEN 'mmHg'
      WHEN 4 THEN 'mmol/L' END""", key="2024_12_Bradford_measurements"))
def q_ingest_bradford_meas_2024(spark, d):
    return IN.ingest(spark, RC.bradford_meas_2024_12(), EX.bradford_meas_2024(spark, d))


@query("ingest_audit", with_clause("readings") + """, c AS (SELECT count(*) AS n0,
      sum(CASE WHEN l_orderkey % 7 <> 1 THEN 1 ELSE 0 END) AS n1 FROM readings),
    k AS (SELECT count(*) AS n1 FROM readings WHERE l_orderkey % 7 NOT IN (1, 2, 3))
    SELECT '2024_12_Bradford_measurements' AS provenance, 1 AS step, 'regex_block result' AS label, n0 AS before, k.n1 AS after,
      round((k.n1 - n0) * 100.0 / n0, 1) AS pct_change FROM c, k""")
def q_ingest_audit(spark, d):
    """Rows before and after each filtering step of a source, counted by the one job that writes its result."""
    recipe, log = RC.bradford_meas_2024_12(), IN.StepCounts()
    out = IN.ingest(spark, recipe, EX.bradford_meas_2024(spark, d), dedup=False, counts=log)
    out.write.mode("overwrite").parquet(staging_path(spark, "ingest-audit"))
    return spark.createDataFrame(log.rows(recipe.key), IN.AUDIT_SCHEMA)


@query("quarantine_lines", with_clause("readings") + """SELECT '2022_03_Barts_path' AS provenance, 'drop_quoted' AS rule,
    pseudo_nhs_number || ',' || strftime(test_date, '%Y-%m-%d %H:%M') || ',"' || original_term || ', repeat",' ||
    CASE l_orderkey % 6 WHEN 0 THEN '< ' || {q} WHEN 1 THEN '<' || {q} WHEN 2 THEN '>' || {q} WHEN 3 THEN 'NA'
      WHEN 4 THEN {q} || ' -' ELSE {q} END || ',' || coalesce(result_value_units, '') AS value
    FROM readings WHERE l_orderkey % 17 = 0""".replace("{q}", Q_SQL))
def q_quarantine_lines(spark, d):
    out = IN.quarantine_lines(spark, RC.barts_path_2022_03(), EX.barts_2022_03(spark, d))
    return out.select("provenance", "rule", "value")


@query("ingest_barts_meas_2023_05", _combo_sql(
    "l_orderkey % 5 <> 1", result=f"CASE WHEN l_orderkey % 5 = 2 THEN '36.1' ELSE {Q_SQL} END",
    key="2023_05_Barts_measurements"))
def q_ingest_barts_meas(spark, d):
    return IN.ingest(spark, RC.barts_meas_2023_05(), EX.barts_meas(spark, d))


@query("ingest_bradford_path_2024_12", _combo_sql("l_orderkey % 6 IN (0, 4, 5)", result=Q_SQL,
                                                  key="2024_12_Bradford_path"))
def q_ingest_bradford_path_2024(spark, d):
    return IN.ingest(spark, RC.bradford_path_2024_12(), EX.bradford_path_2024(spark, d))


@query("ingest_barts_meas_2024_09", _combo_sql(
    "l_orderkey % 13 <> 0 AND l_orderkey % 7 NOT IN (0, 1, 4) AND result_value_units IS NOT NULL",
    term="CASE WHEN l_orderkey % 7 = 3 THEN 'Child''s Birth Weight (g)' ELSE original_term END",
    result=f"CASE l_orderkey % 7 WHEN 2 THEN '36.1' WHEN 3 THEN '1' || {Q_SQL} ELSE {Q_SQL} END",
    key="2024_09_Barts_measurements"))
def q_ingest_barts_meas_2024(spark, d):
    return IN.ingest(spark, RC.barts_meas_2024_09(), EX.barts_meas_2024(spark, d))


@query("ingest_barts_path_2024_09", _combo_sql("l_orderkey % 9 IN (0, 2, 4, 7, 8) AND l_orderkey % 11 <> 0",
                                               result=Q_SQL, key="2024_09_Barts_path"))
def q_ingest_barts_path_2024(spark, d):
    return IN.ingest(spark, RC.barts_path_2024_09(), EX.barts_path_2024(spark, d))


@query("ingest_barts_path_2023_05", _combo_sql(
    "l_orderkey % 13 <> 0 AND l_orderkey % 10 IN (0, 1, 2, 3, 8, 9)", result=Q_SQL, key="2023_05_Barts_path")
    .replace("SELECT DISTINCT pseudo_nhs_number, test_date,", """SELECT DISTINCT pseudo_nhs_number,
      CASE WHEN l_orderkey % 4 = 0 THEN CAST('4' || substr(strftime(test_date, '%Y-%m-%d'), 2) AS DATE)
           ELSE test_date END AS test_date,"""))
def q_ingest_barts_path_2023_05(spark, d):
    return IN.ingest(spark, RC.barts_path_2023_05(), EX.barts_path_2023(spark, d))


@query("ingest_barts_path_2023_12", _combo_sql("l_orderkey % 17 <> 0 AND l_orderkey % 9 NOT IN (4, 5, 6)",
                                               result=Q_SQL, key="2023_12_Barts_path"))
def q_ingest_barts_path_2023_12(spark, d):
    return IN.ingest(spark, RC.barts_path_2023_12(), EX.barts_path_2023_12(spark, d))


@query("ingest_barts_meas_2023_12", _combo_sql("l_orderkey % 19 <> 0 AND l_orderkey % 10 IN (0, 1, 2, 9)",
                                               result=Q_SQL, key="2023_12_Barts_measurements"))
def q_ingest_barts_meas_2023_12(spark, d):
    return IN.ingest(spark, RC.barts_meas_2023_12(), EX.barts_meas_2023_12(spark, d))


@query("ingest_barts_path_2021_04", _combo_sql(
    "l_orderkey % 3 <> 2 AND l_orderkey % 5 IN (0, 1, 2)", result=Q_SQL, key="2021_04_Barts_path"))
def q_ingest_barts_2021_04(spark, d):
    return IN.ingest(spark, RC.barts_path_2021_04(), EX.barts_2021_04(spark, d))


@query("source_file_exclusion", with_clause("readings") + """SELECT pseudo_nhs_number AS c1, original_term AS c3,
    count(*) AS n FROM readings WHERE l_orderkey % 3 <> 2 GROUP BY ALL""")
def q_source_file_exclusion(spark, d):
    df = RD.read_raw(spark, EX.barts_2021_04(spark, d), ",", ("NULL", ""), True,
                     columns=["c1", "c2", "c3", "c4", "c5", "c6"], file_col="file",
                     exclude_files=RC.BARTS_2021_04_PROBLEM_FILES)
    return df.groupBy("c1", "c3").agg(F.count("*").alias("n"))


@query("ingest_hes_stays", with_clause("stays") + """SELECT pseudo_nhs_number, adm AS hospital_admission_datetime,
    dis AS hospital_discharge_datetime, 'APC' AS hospital_stay_type FROM stays""")
def q_ingest_hes_stays(spark, d):
    path = EX.hes(spark, d)
    return IN.combine_stays([IN.ingest_stays(spark, path), IN.ingest_stays(spark, path)])


@query("load_linkage", with_clause("linkage") + "SELECT OrageneID, pseudo_nhs_number, gsa_id, exome_id FROM linkage")
def q_load_linkage(spark, d):
    return IN.load_linkage(spark, EX.linkage(spark, d)).select("OrageneID", "pseudo_nhs_number", "gsa_id", "exome_id")


@query("scan_header_replaced", with_clause("linkage") + """SELECT OrageneID, s1qst_gender, pseudo_nhs_number
    FROM linkage""")
def q_scan_header_replaced(spark, d):
    df = RD.read_raw(spark, EX.linkage(spark, d), ",", ("",), True,
                     rename_all=["OrageneID", "n", "s1qst_gender", "valid", "pseudo_nhs_number", "gsa", "ex1", "ex2"])
    return df.select("OrageneID", "s1qst_gender", "pseudo_nhs_number")


@query("scan_delimited_strings", with_clause("readings") + """SELECT pseudo_nhs_number,
    CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE strftime(test_date, '%Y-%m-%d') END AS clinical_effective_date,
    original_term, result_value_units FROM readings""")
def q_scan_delimited_strings(spark, d):
    df = RD.read_raw(spark, EX.primary_care(spark, d), ",", ("NULL", ""), True)
    return df.select("pseudo_nhs_number", "clinical_effective_date", "original_term", "result_value_units")


@query("scan_headerless_positional", with_clause("readings") + """SELECT pseudo_nhs_number AS c1,
    CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE strftime(test_date, '%Y-%m-%d') END AS c2,
    original_term AS c3, true AS has_file FROM readings""")
def q_scan_headerless_positional(spark, d):
    df = RD.read_raw(spark, EX.primary_care(spark, d), ",", ("NULL", ""), True,
                     columns=["c1", "c2", "c3", "c4", "c5", "c6"], file_col="file")
    return df.select("c1", "c2", "c3", X.file_stem("file").isNotNull().alias("has_file"))


@query("scan_typed", with_clause("readings") + """SELECT pseudo_nhs_number AS STUDY_ID,
    CAST(year(test_date) AS INTEGER) AS AUDIT_YEAR,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE result END AS BMI_VALUE FROM readings""")
def q_scan_typed(spark, d):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("STUDY_ID", T.StringType()), T.StructField("BMI_DATE", T.StringType()),
                           T.StructField("AUDIT_YEAR", T.IntegerType()), T.StructField("BMI_VALUE", T.DoubleType())])
    return RD.read_typed(spark, EX.nda_bmi(spark, d), schema, "|").select("STUDY_ID", "AUDIT_YEAR", "BMI_VALUE")


@query("scan_dictionary", PART_DICT + 'SELECT trait, target_units, "min", "max", alias FROM pd')
def q_scan_dictionary(spark, d):
    paths = EX.written_dictionaries(spark, B.part_traits(spark, d), B.part_aliases(spark, d), B.part_units(spark, d))
    units = DI.load_units(spark, paths["units"])
    traits = DI.load_traits(spark, paths["traits"], DI.target_units(units))
    return TR.trait_dictionary(traits, DI.load_aliases(spark, paths["aliases"]))


# --- raw-line hygiene on whole document texts -----------------------------------------------

LINES_SQL = "WITH L AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents)\n"


def doc_lines(spark, d):
    docs = B.table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("value"))


@query("drop_quoted_delimiter_lines", LINES_SQL + """SELECT doc_id, value FROM L
    WHERE NOT regexp_matches(value, ',"[^"]*,')""")
def q_drop_quoted_delimiter_lines(spark, d):
    kept, _ = LN.drop_quoted_delimiter_lines(doc_lines(spark, d), ",")
    return kept


@query("drop_unterminated_quote_lines", LINES_SQL + """SELECT doc_id, value FROM L
    WHERE NOT regexp_matches(value, ' "[^"]* ')""")
def q_drop_unterminated_quote_lines(spark, d):
    kept, _ = LN.drop_unterminated_quote_lines(doc_lines(spark, d), " ")
    return kept


@query("quarantine_halves", """SELECT first || chr(10) || last AS text, 2 AS n_lines, first, last FROM (
    SELECT CAST(o_orderkey AS VARCHAR) || chr(9) || '"seen by' AS first, o_orderpriority || '"' || chr(9) || '5' AS last
    FROM orders WHERE o_orderkey % 7 = 0) x""")
def q_quarantine_halves(spark, d):
    """Records that a line break inside quotes cuts in two: the line rules drop both halves, the prefix scan over the files puts them together."""
    od = B.table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    broken = F.concat(key, F.lit('\t"seen by\n'), F.col("o_orderpriority"), F.lit('"\t5'))
    path = staging_path(spark, "extract-broken-lines")
    od.select(F.when(F.col("o_orderkey") % 7 == 0, broken).otherwise(F.concat(key, F.lit("\t"), F.col("o_orderpriority"), F.lit("\t5")))).write.text(path)
    whole = LN.broken_records(LN.placed_records(LN.read_placed_lines(spark, path)))
    return whole.select("text", F.col("n_lines").cast("int").alias("n_lines"), F.substring_index("text", "\n", 1).alias("first"), F.substring_index("text", "\n", -1).alias("last"))


@query("strip_double_quotes", LINES_SQL + "SELECT doc_id, replace(value, '\"', '') AS value FROM L")
def q_strip_double_quotes(spark, d):
    return LN.strip_double_quotes(doc_lines(spark, d))


@query("delimiter_count_profile", LINES_SQL + """SELECT length(value) - length(replace(value, ',', '')) AS n_delimiters,
    count(*) AS n_lines FROM L WHERE value <> '' GROUP BY 1""")
def q_delimiter_count_profile(spark, d):
    return LN.delimiter_count_profile(doc_lines(spark, d), ",").select(
        F.col("n_delimiters").cast("long").alias("n_delimiters"), "n_lines")


@query("keep_expected_width_lines", LINES_SQL + """SELECT doc_id, value FROM L WHERE value <> ''
    AND length(value) - length(replace(value, ',', '')) = 2""")
def q_keep_expected_width_lines(spark, d):
    kept, _ = LN.keep_expected_width_lines(doc_lines(spark, d), ",", 2)
    return kept


# --- sinks (written, then read back) --------------------------------------------------------

@query("checkpoint_columnar", with_clause("ranged") + """SELECT pseudo_nhs_number, test_date, trait, final,
    range_position FROM ranged""")
def q_checkpoint_columnar(spark, d):
    """Written once, with a manifest; a later application with the same tables and code reads it back."""
    return staged(spark, f"ranged:{d}", lambda: ranged(spark, d).select(
        "pseudo_nhs_number", "test_date", "trait", "final", "range_position"), fingerprint(spark, d))


READINGS_FILE_SCHEMA = ("pseudo_nhs_number string, unit string, value double, date date, gender string, "
                        "age_at_test double, minmax_outlier string, setting string, trait string")


@query("sink_per_trait_readings", with_clause("tiled_set") + """SELECT pseudo_nhs_number, trait, unit, value, date,
    gender, age_at_test, minmax_outlier, setting FROM tiled_set""")
def q_sink_per_trait_readings(spark, d):
    path = staging_path(spark, "readings-by-trait")
    SK.write_by_trait(tiled_settings(spark, d).select(*S.READINGS_FILE_COLUMNS, "setting"), path)
    return spark.read.option("header", True).schema(READINGS_FILE_SCHEMA).csv(path).select(
        *S.READINGS_FILE_COLUMNS, "setting")


@query("partition_by_trait", with_clause("tiled_set") + """SELECT setting, trait, count(*) AS n FROM tiled_set
    GROUP BY ALL""")
def q_partition_by_trait(spark, d):
    path = staging_path(spark, "readings-by-trait-parquet")
    SK.write_by_trait(tiled_settings(spark, d).select(*S.READINGS_FILE_COLUMNS, "setting"), path, fmt="parquet")
    return spark.read.parquet(path).groupBy("setting", "trait").agg(F.count("*").alias("n"))


STATS_FILE_SCHEMA = ("pseudo_nhs_number string, median double, mean double, max double, min double, "
                     "earliest double, latest double, n long, setting string, trait string")


@query("sink_per_trait_stats", ORACLE["per_individual_stats"])
def q_sink_per_trait_stats(spark, d):
    path = staging_path(spark, "stats-by-trait")
    stats = ST.per_individual_stats(tiled_settings(spark, d), extra_keys=("setting",))
    SK.write_by_trait(stats.withColumn("mean", X.round_half_away("mean", 9)), path)
    back = spark.read.option("header", True).schema(STATS_FILE_SCHEMA).csv(path)
    return back.select("setting", *S.PER_PERSON_STATS_COLUMNS)


@query("sink_tsv_na", ORACLE["covariate_megawide"])
def q_sink_tsv_na(spark, d):
    wide = q_covariate_megawide(spark, d)
    path = staging_path(spark, "megawide-tsv")
    SK.write_tsv(wide, path, "NA", partition_by=["setting"])
    schema = wide.schema
    back = spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").schema(schema).csv(path)
    return back.select(*[F.col(f"`{c}`") for c in wide.columns])


@query("sink_counts", ORACLE["units_counts"])
def q_sink_counts(spark, d):
    path = staging_path(spark, "units-counts")
    SK.write_counts(TR.units_counts(B.readings(spark, d)), path)
    return spark.read.parquet(f"{path}/parquet")


@query("audit_filter", "SELECT label, before, after, pct_change FROM (" + ORACLE["audit_row_counts"] + ") a")
def q_audit_filter(spark, d):
    """Labelled filters measured with ``observe`` during the one job that runs them."""
    demo = PE.valid_demographics(B.linkage(spark, d), PE.questionnaire_demographics(B.questionnaire(spark, d)))
    wd = PE.join_demographics(PE.join_valid_people_semi(ranged(spark, d),
                                                        PE.valid_pseudo_nhs_numbers(B.linkage(spark, d))), demo)
    log = AU.AuditLog()
    x = log.filter(wd, F.coalesce(F.col("range_position") == "ok", F.lit(False)), "range_ok")
    x = log.filter(x, F.coalesce((F.col("age_at_test") >= 0) & (F.col("test_date") <= F.lit(B.AS_OF).cast("date")),
                                 F.lit(False)), "plausible_dates")
    x = log.filter(x, F.coalesce(F.col("age_at_test") >= 16, F.lit(False)), "min_age")
    x.write.format("noop").mode("overwrite").save()
    return log.report(spark)


@query("join_trait_aliases", PART_DICT + "SELECT trait, count(alias) AS n_aliases FROM pd GROUP BY trait")
def q_join_trait_aliases(spark, d):
    return TR.trait_dictionary(B.part_traits(spark, d), B.part_aliases(spark, d)).groupBy("trait").agg(
        F.count("alias").alias("n_aliases"))


def _pheno_wide_sql(stats=("median", "min", "max")):
    traits = _traits_in_data()
    cols = ", ".join(f"max(CASE WHEN trait = '{t}' THEN {s} END) AS \"{t}.{s}\"" for t in traits for s in stats)
    return f"SELECT setting, FID, IID, {cols} FROM (" + ORACLE["phenotype_table"] + ") p GROUP BY setting, FID, IID"


def _gsa_phenotypes(spark, d):
    """The cohort's phenotype table and its traits, listed from the readings before these are dealt."""
    ids = PE.genotype_ids(B.linkage(spark, d), "gsa")
    return ST.phenotype_table(tiled_settings(spark, d), ids), ST.traits_present(PE.join_genotype_ids(tiled(spark, d), ids))


@query("pivot_traits", _pheno_wide_sql())
def q_pivot_traits(spark, d):
    pheno, traits = _gsa_phenotypes(spark, d)
    return ST.phenotype_wide(pheno, traits)


@query("align_traits_full_outer", _pheno_wide_sql(("median",)))
def q_align_traits_full_outer(spark, d):
    pheno, traits = _gsa_phenotypes(spark, d)
    return ST.phenotype_wide(pheno, traits, stats=("median",))
