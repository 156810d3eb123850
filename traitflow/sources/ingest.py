"""Generic ingest: a ``Recipe`` (data) -> canonical readings (combo rows), deduplicated.

A recipe lists, in order, the steps the source needs: line rules, reading, renames, row
filters and result-text cleaning, then the typed parse of date and result. Everything is a
Spark column expression or filter; the steps of one source become one Catalyst plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from traitflow.functions import scalars as X
from traitflow.operators import audit as AU
from traitflow.operators import dedup as DD
from traitflow.operators import filters as FL
from traitflow.sources import lines as LN
from traitflow.sources.readers import read_raw

# Step kinds (first element of each step tuple):
#   not_null [cols] | ne col [values] | regex_block col [patterns] | starts_block col [prefixes]
#   ends_block col [suffixes] | regex_keep col pattern | strip_prefix col [prefixes]
#   strip_suffix col [suffixes] | replace_first col pattern repl | replace_all_literal col text repl
#   unwrap col | nonempty col | value_repair col term text | unit_from_term term_col [(needle, unit)]
#   unit_for_term term unit


@dataclass
class Recipe:
    key: str                                   # provenance
    source: str = "secondary_care"
    sep: str = ","
    null_values: tuple = ("",)
    header: bool = True
    columns: list | None = None                # positional names (header line skipped)
    line_rules: list = field(default_factory=list)   # ("drop_quoted", sep) | ("strip_quotes",) | ("width", n)
    rename: dict = field(default_factory=dict)       # raw -> canonical
    constants: dict = field(default_factory=dict)    # canonical -> literal
    steps: list = field(default_factory=list)
    date_col: str = "test_date"
    date_format: str = "yyyy-MM-dd"
    date_strict: bool = True
    date_candidates: list | None = None        # first valid of these columns
    clock12: bool = False                      # 'Apr 11 2022  5:12AM' dates
    result_strict: bool = True
    unpivot: dict | None = None                # {raw value column: term}
    exclude_files: list = field(default_factory=list)
    file_col: str | None = None


def apply_step(df: DataFrame, step: tuple) -> DataFrame:
    kind, *args = step
    if kind == "not_null":
        return FL.filter_not_null_all(df, args[0])
    if kind == "ne":
        return FL.filter_literal_blocklist(df, args[0], args[1])
    if kind == "regex_block":
        return FL.filter_regex_blocklist(df, args[0], args[1])
    if kind == "starts_block":
        return FL.filter_prefix_suffix(df, args[0], starts=args[1])
    if kind == "ends_block":
        return FL.filter_prefix_suffix(df, args[0], ends=args[1])
    if kind == "regex_keep":
        return FL.filter_regex_allowlist(df, args[0], args[1])
    if kind == "strip_prefix":
        return df.withColumn(args[0], X.strip_prefix_chain(args[0], args[1]))
    if kind == "strip_suffix":
        return df.withColumn(args[0], X.strip_suffix_chain(args[0], args[1]))
    if kind == "replace_first":
        return df.withColumn(args[0], X.replace_first(args[0], args[1], args[2]))
    if kind == "replace_all_literal":
        return df.withColumn(args[0], X.replace_all_literal(args[0], args[1], args[2]))
    if kind == "unwrap":
        return df.withColumn(args[0], X.unwrap_brackets(args[0]))
    if kind == "nonempty":
        return FL.filter_nonempty(df, args[0])
    if kind == "value_repair":
        return FL.conditional_value_repair(df, args[0], "original_term", args[1], args[2])
    if kind == "unit_from_term":
        return FL.impute_unit_from_term(df, args[0], args[1])
    if kind == "unit_for_term":
        return FL.impute_unit_for_term(df, args[0], args[1])
    raise ValueError(f"unknown step {kind}")


def source_lines(spark: SparkSession, recipe: Recipe, paths) -> tuple[DataFrame, DataFrame | None]:
    """(kept, rejected): the lines of a source after its line rules, and the lines they set aside
    (value, file_path, rule)."""
    lines, rejected = LN.read_lines(spark, paths), None
    for rule in recipe.line_rules:
        bad = None
        if rule[0] == "drop_quoted":
            lines, bad = LN.drop_quoted_delimiter_lines(lines, rule[1])
        elif rule[0] == "strip_quotes":
            lines = LN.strip_double_quotes(lines)
        elif rule[0] == "width":
            lines, bad = LN.keep_expected_width_lines(lines, recipe.sep, rule[1])
        if bad is not None:
            bad = bad.select("value", "file_path", F.lit(rule[0]).alias("rule"))
            rejected = bad if rejected is None else rejected.unionByName(bad)
    return lines, rejected


def quarantine_lines(spark: SparkSession, recipe: Recipe, paths) -> DataFrame | None:
    """The lines of a source that its rules reject: provenance, rule, file, value. None for a recipe without line rules."""
    _, rejected = source_lines(spark, recipe, paths)
    if rejected is None:
        return None
    return rejected.select(F.lit(recipe.key).alias("provenance"), "rule", X.file_stem("file_path").alias("file"), "value")


def read_source(spark: SparkSession, recipe: Recipe, paths) -> DataFrame:
    """Raw all-string rows of a source, after its line rules."""
    if not recipe.line_rules:
        return read_raw(spark, paths, recipe.sep, recipe.null_values, recipe.header, recipe.columns,
                        file_col=recipe.file_col, exclude_files=recipe.exclude_files)
    lines, _ = source_lines(spark, recipe, paths)
    columns = recipe.columns
    if columns is None:
        if not recipe.header:
            raise ValueError("line rules on a headerless source need the column list")
        known = list(recipe.rename) + list(recipe.date_candidates or [])
        columns = LN.header_columns(lines, recipe.sep, known)
        lines = LN.check_headers(lines, recipe.sep, columns, known)
    return LN.parse_lines(lines, recipe.sep, columns, recipe.null_values, recipe.header)


def unpivot_bp(df: DataFrame, id_col: str, date_col: str, fmt: str | None = None) -> DataFrame:
    """Two blood-pressure value columns -> one reading per value (both must be present)."""
    terms = {"DIASTOLIC_VALUE": "Diastolic arterial pressure", "SYSTOLIC_VALUE": "Systolic arterial pressure"}
    d = FL.filter_not_null_all(df, list(terms))
    date = X.parse_date_strict(date_col, fmt) if fmt else F.col(date_col)
    d = d.select(F.col(id_col).alias("pseudo_nhs_number"), date.alias("test_date"),
                 *[F.col(k).alias(v) for k, v in terms.items()])
    long = d.unpivot(["pseudo_nhs_number", "test_date"], list(terms.values()), "original_term", "result")
    return long.select("pseudo_nhs_number", "test_date", "original_term", F.col("result").cast("double"),
                       F.lit("mmHg").alias("result_value_units"))


class StepCounts:
    """Rows after each labelled step of an ingest, counted by ``observe`` in the job that writes the result."""

    def __init__(self):
        self.steps: list[tuple[str, Observation]] = []

    def see(self, df: DataFrame, label: str) -> DataFrame:
        seen = Observation()     # named by a UUID: several sources meet in one plan
        self.steps.append((label, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def rows(self, provenance: str) -> list[tuple]:
        """(provenance, step, label, before, after, pct_change) of each step, after the job has run."""
        counts = [seen.get["n"] for _, seen in self.steps]
        return [(provenance, i, self.steps[i][0], b, a, None if b == 0 else AU._round1((a - b) * 100.0 / b))
                for i, (b, a) in enumerate(zip(counts, counts[1:]), start=1)]


AUDIT_SCHEMA = "provenance string, step int, label string, before long, after long, pct_change double"
FILTER_STEPS = {"not_null", "ne", "regex_block", "starts_block", "ends_block", "regex_keep", "nonempty"}


def step_label(step: tuple) -> str:
    kind, *args = step
    where = ",".join(args[0]) if isinstance(args[0], list) else str(args[0])
    return f"{kind} {where}"


def ingest(spark: SparkSession, recipe: Recipe, paths, dedup: bool = True, counts: StepCounts | None = None) -> DataFrame:
    """Source files -> combo rows tagged with the recipe's provenance, deduplicated unless a later merge does it.

    ``counts`` collects the rows before and after each filtering step while the result is written."""
    see = counts.see if counts is not None else (lambda df, label: df)
    df = see(read_source(spark, recipe, paths), "read")
    if recipe.unpivot:
        (id_col, date_col) = [k for k, v in recipe.rename.items() if v in ("pseudo_nhs_number", "test_date")]
        long = unpivot_bp(df, id_col, date_col, recipe.date_format)
        out = see(FL.canonical_select(FL.tag_provenance(long, recipe.key, recipe.source)), "unpivot")
        return DD.dedup_constant_source(out, recipe.key, recipe.source) if dedup else out
    for raw, canon in recipe.rename.items():
        df = df.withColumnRenamed(raw, canon)
    for canon, value in recipe.constants.items():
        df = df.withColumn(canon, F.lit(value))
    # all that later filters read is computed together: a filter on a column that is not would go below, before earlier ones
    used = ["pseudo_nhs_number", "test_date", "original_term", "result", "result_value_units", recipe.date_col, *(recipe.date_candidates or [])]
    changed = False
    for step in recipe.steps:
        if step[0] in FILTER_STEPS:
            if changed:
                df, changed = FL.computed(df, used), False
            df = see(apply_step(df, step), step_label(step))
        else:
            df, changed = apply_step(df, step), True
    if changed:
        df = FL.computed(df, used)
    if recipe.date_candidates:
        date = X.first_valid_date(recipe.date_candidates, recipe.date_format)
    elif recipe.clock12:
        date = X.parse_date_clock12(recipe.date_col, recipe.date_strict)
    elif recipe.date_strict:
        date = X.parse_date_strict(recipe.date_col, recipe.date_format, recipe.date_col)
    else:
        date = X.parse_date_lenient(recipe.date_col, recipe.date_format)
    result = (X.parse_number_strict("result") if recipe.result_strict else X.parse_number_lenient("result"))
    df = df.withColumn("test_date", date).withColumn("result", result)
    if not recipe.result_strict:
        df = see(FL.filter_not_nan(df, "result"), "result is a number")
    if not recipe.date_strict or recipe.date_candidates or recipe.clock12:
        df = see(df.filter(F.col("test_date").isNotNull()), "date is valid")
    if "result_value_units" not in df.columns:
        df = df.withColumn("result_value_units", F.lit(None).cast("string"))
    out = FL.canonical_select(FL.tag_provenance(df, recipe.key, recipe.source))
    return DD.dedup_constant_source(out, recipe.key, recipe.source) if dedup else out


def ingest_stays(spark: SparkSession, paths, sep: str = "|", id_col: str = "STUDY_ID",
                 admission_col: str = "ADMIDATE", discharge_col: str = "DISDATE") -> DataFrame:
    """Hospital-stay extract -> (person, admission 00:00:00, discharge 23:59:59, type)."""
    raw = read_raw(spark, paths, sep, ("",), True)
    raw = raw.filter(F.col(admission_col).isNotNull())
    return raw.select(F.col(id_col).alias("pseudo_nhs_number"),
                      X.day_bounds(admission_col).alias("hospital_admission_datetime"),
                      X.day_bounds(discharge_col, end=True).alias("hospital_discharge_datetime"),
                      F.lit("APC").alias("hospital_stay_type"))


def combine_stays(stays: list[DataFrame]) -> DataFrame:
    """Pulls of stays -> one table without repeated rows."""
    return DD.dedup_full_row(DD.union_sources(stays))


def load_linkage(spark: SparkSession, paths) -> DataFrame:
    """Linkage file with its header replaced by fixed positional names."""
    names = ["OrageneID", "n_oragene_ids", "s1qst_gender", "HasValidNHS", "pseudo_nhs_number", "gsa_id",
             "exome_id_2023", "exome_id"]
    return read_raw(spark, paths, ",", ("",), True, rename_all=names)


def load_questionnaire(spark: SparkSession, paths) -> DataFrame:
    return read_raw(spark, paths, ",", ("",), True).select(
        "S1QST_Oragene_ID", "S1QST_Gender", "S1QST_MM-YYYY_ofBirth")

