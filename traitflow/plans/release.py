"""A whole release, from raw extracts to output files, as Spark jobs.

    cfg = ReleaseConfig(sources=[(recipes.primary_care("2024_12_Discovery_path"), "/data/pc/*.csv"), ...],
                        stays=[("/data/hes/2024_10.txt", "|")], traits=..., aliases=..., units=...,
                        linkage=..., questionnaire=..., as_of="2025-04-01", output="/shared/release")
    paths = run_release(spark, cfg)

Stages written as Parquet (shared folder, lineage cut, survive executor loss): the merged
readings ("combo"), the admission segments, the checked readings and the tiled readings; every output reads the
tiled stage. Outputs are partitioned by setting (and trait), each written in one pass.

A run is named by a digest of its inputs and of the code. Started again after a loss, it reads the stages and
keeps the outputs that were complete; run again when all was published, it does nothing. Outputs are published together
(``sources/publish.py``). With ``combo_store`` the merged readings are kept between releases: a release reads and
shuffles only the sources that the store does not hold yet (``operators/combo.py``).
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from traitflow.operators import audit as AU
from traitflow.operators import combo as CO
from traitflow.operators import dedup as DD
from traitflow.operators import filters as FL
from traitflow.operators import intervals as IV
from traitflow.operators import people as PE
from traitflow.operators import regions as RG
from traitflow.operators import stats as ST
from traitflow.operators import traits as TR
from traitflow.plans import pipeline as P
from traitflow.plans.registry import StageRegistry, code_digest, fingerprint
from traitflow.sources import files as FS
from traitflow.sources import dictionaries as DI
from traitflow.sources import ingest as IN
from traitflow.sources import recipes as RC
from traitflow.sources import publish as PU
from traitflow.sources import sinks as SK
from traitflow.sources.ingest import Recipe
from traitflow import schema as S


@dataclass
class ReleaseConfig:
    sources: list[tuple[Recipe, object]]          # (recipe, path / glob / list of paths)
    stays: list[tuple[object, str]]               # (path, separator) per stay pull
    traits: str
    aliases: str
    units: str
    linkage: str
    questionnaire: str
    as_of: str
    output: str
    provenance_order: list[str] = field(default_factory=lambda: list(RC.PROVENANCE_ORDER))
    unit_fills: list[tuple[str, str]] = field(default_factory=lambda: list(RC.COMBO_UNIT_FILLS))
    combo_store: str | None = None                # folder of the stored combo, kept between releases


def _digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()[:16]


def _files_digest(spark: SparkSession, paths) -> str:
    patterns = paths if isinstance(paths, (list, tuple)) else [paths]
    return fingerprint(spark, *[p for pattern in patterns for p in FS.matching(spark, str(pattern))])


def inputs_digest(spark: SparkSession, cfg: ReleaseConfig) -> str:
    """Digest of every input file and setting that decides the outputs."""
    files = [_files_digest(spark, p) for p in [x for _, x in cfg.sources] + [x for x, _ in cfg.stays] + [
        cfg.traits, cfg.aliases, cfg.units, cfg.linkage, cfg.questionnaire]]
    return _digest([r.key for r, _ in cfg.sources], [sep for _, sep in cfg.stays], files, cfg.as_of, cfg.provenance_order, cfg.unit_fills)


def _filled(combo: DataFrame, cfg: ReleaseConfig) -> DataFrame:
    for term, unit in cfg.unit_fills:
        combo = FL.impute_unit_for_term(combo, term, unit)
    return combo


def build_combo(spark: SparkSession, cfg: ReleaseConfig, counts: list | None = None) -> DataFrame:
    """Every source through its recipe, merged with one dedup, missing units filled. ``counts`` gets a
    ``StepCounts`` per provenance."""
    parts = []
    for recipe, paths in cfg.sources:
        log = IN.StepCounts() if counts is not None else None
        if counts is not None:
            counts.append((recipe.key, log))
        parts.append(IN.ingest(spark, recipe, paths, dedup=False, counts=log))
    return _filled(DD.merge(parts, cfg.provenance_order), cfg)


def stored_combo(spark: SparkSession, cfg: ReleaseConfig) -> tuple[DataFrame, list[tuple]]:
    """The same from the stored combo, after the sources that it does not hold are added, and the step counts of all sources.
    What is in the store is noted per source, after it was added; a source whose files have changed since cannot be taken
    out of the merged readings again, so it fails the job (build another store)."""
    store = CO.ComboStore(spark, cfg.combo_store, cfg.provenance_order)
    steps = []
    for recipe, paths in cfg.sources:
        note = f"{store.path}/_added/{_digest(recipe.key)}.json"
        files = _files_digest(spark, paths)
        known = json.loads(FS.read_text(spark, note) or "null")
        if known is None:
            log = IN.StepCounts()
            store.add(IN.ingest(spark, recipe, paths, dedup=False, counts=log))
            known = {"source": recipe.key, "files": files, "steps": log.rows(recipe.key)}
            FS.write_text(spark, note, json.dumps(known))
        elif known["files"] != files:
            raise ValueError(f"the files of {recipe.key} are not those in the stored combo {store.path}")
        steps += [tuple(row) for row in known["steps"]]
    return _filled(store.read(), cfg), steps


def run_release(spark: SparkSession, cfg: ReleaseConfig) -> dict[str, str]:
    """Write and publish a release; the paths of its outputs."""
    out = cfg.output.rstrip("/")
    inputs = inputs_digest(spark, cfg)
    release = PU.Release(spark, out, f"{inputs}-{code_digest()}")
    if release.complete():
        return release.promote()
    stages = StageRegistry(spark, f"{out}/stages")

    if release.recorded("logs/ingest_audit"):
        combo = stages.stage("combo", inputs, lambda: stored_combo(spark, cfg)[0] if cfg.combo_store else build_combo(spark, cfg))
    else:       # the counts are made while the combo is written
        logs: list = []
        merged, steps = stored_combo(spark, cfg) if cfg.combo_store else (build_combo(spark, cfg, logs), [])
        combo = stages.open(stages.write("combo", inputs, merged))
        steps += [row for key, log in logs for row in log.rows(key)]
        release.sink("logs/ingest_audit", lambda p: SK.write_counts(spark.createDataFrame(steps, IN.AUDIT_SCHEMA), p))
    for i, (recipe, source) in enumerate(cfg.sources):
        rejected = IN.quarantine_lines(spark, recipe, source)
        if rejected is not None:
            release.sink(f"quarantine/lines/source={i}", rejected.write.mode("overwrite").parquet)

    stays = IN.combine_stays([IN.ingest_stays(spark, p, sep) for p, sep in cfg.stays])
    segments = stages.stage("segments", inputs, lambda: IV.admission_windows(stays))
    units = DI.load_units(spark, cfg.units)
    traits = DI.load_traits(spark, cfg.traits, DI.target_units(units))
    aliases = DI.load_aliases(spark, cfg.aliases)
    linkage = IN.load_linkage(spark, cfg.linkage)
    AU.check_unique_ids(linkage, "OrageneID")
    AU.check_m1(segments, ["pseudo_nhs_number", "start_date"])
    questionnaire = IN.load_questionnaire(spark, cfg.questionnaire)

    # every reading with the rule that drops it, rule by rule in folders: the tiles read the kept ones only
    rules = P.reading_rules(cfg.as_of)
    checked = stages.stage("checked", inputs, lambda: P.traced_readings(
        combo, traits, aliases, units, linkage, questionnaire, cfg.as_of), partition_by=["rule"])
    release.sink("logs/rule_counts", lambda p: SK.write_counts(AU.rule_counts(checked, rules), p))
    release.sink("quarantine/readings", lambda p: AU.quarantine(checked, rules).write.mode("overwrite").partitionBy("reason").parquet(p))
    tiled = stages.stage("tiled", inputs, lambda: P.tiled_regions(checked.filter("rule = 0"), segments))
    by_setting = RG.setting_split(tiled)

    release.sink("individual_trait_files/readings", lambda p: SK.write_by_trait(by_setting.select(*S.READINGS_FILE_COLUMNS, "setting"), p))
    release.sink("individual_trait_files/per_individual_stats", lambda p: SK.write_by_trait(
        ST.per_individual_stats(by_setting, extra_keys=("setting",)), p))
    release.sink("trait_summary", lambda p: SK.write_counts(ST.trait_study_summary(by_setting), p))
    release.sink("trait_histograms", lambda p: SK.write_counts(ST.trait_log10_histogram(by_setting), p))
    for cohort in ("gsa", "exome"):
        ids = PE.genotype_ids(linkage, cohort)
        # read by the per-trait files and the wide table: written once
        pheno = stages.stage(f"phenotype_{cohort}", inputs, lambda: ST.phenotype_table(by_setting, ids), partition_by=["trait"])
        release.sink(f"phenotypes/{cohort}", lambda p: SK.write_named_by_trait(pheno, p, ST.traits_present(pheno), ["median", "min", "max"]))
        release.sink(f"phenotypes_wide/{cohort}", lambda p: SK.write_tsv(ST.phenotype_wide(pheno), p, "NA", partition_by=["setting"]))
        release.sink(f"covariates/{cohort}", lambda p: SK.write_tsv(ST.covariate_megawide(by_setting, ids), p, "NA", partition_by=["setting"]))
    release.sink("logs/units_counts", lambda p: SK.write_counts(TR.units_counts(combo), p))
    stage_paths = {key: stages.find(key, inputs)["path"] for key in ("combo", "segments", "checked", "tiled")}
    return release.promote(stage_paths)
