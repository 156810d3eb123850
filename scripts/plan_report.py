"""Summarise the physical plans of the headline queries into docs/PLANS.md.

For each query: number of shuffles (Exchange hashpartitioning / rangepartitioning), join
strategies, aggregate kinds, window operators, and whether scans carry pushed filters. The
pipeline is planned without the catalog's stages and the interval algebra is shown on its own."""

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from traitflow.operators import regions as RG  # noqa: E402
from traitflow.plans import bindings as B  # noqa: E402
from traitflow.plans import catalog as C  # noqa: E402
from traitflow.plans import pipeline as P  # noqa: E402
from traitflow.session import get_spark  # noqa: E402

KEYS = ["admission_windows", "join_regions_m1", "harmonise_units", "dedup_readings", "tile_dedup_11d",
        "units_counts", "ingest_primary_care", "ingest_barts_path_2022_03", "drop_quoted_delimiter_lines"]
OUTPUT_KEYS = ["per_individual_stats", "trait_study_summary", "trait_log10_histogram", "phenotype_table",
               "covariate_megawide"]


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(plan):
    head = plan.split("\n\n(1)")[0]
    count = lambda pat: len(re.findall(pat, head))
    joins = {j: count(r"\b" + j + r"\b") for j in ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                                                   "BroadcastNestedLoopJoin", "CartesianProduct"]}
    aggs = {a: count(r"\b" + a + r"\b") for a in ["HashAggregate", "SortAggregate", "ObjectHashAggregate"]}
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    return {
        "shuffles": count(r"Exchange \(") - count(r"BroadcastExchange \("),
        "broadcasts": count(r"BroadcastExchange \("),
        "joins": ", ".join(f"{k}×{v}" for k, v in joins.items() if v) or "-",
        "aggregates": ", ".join(f"{k}×{v}" for k, v in aggs.items() if v) or "-",
        "windows": count(r"\bWindow \("),
        "scans with pushed filters": sum(1 for p in pushed if p.strip()),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8, extra_conf={"spark.ui.showConsoleProgress": "false"})
    rows = []
    pipe = P.quant_pipeline(B.readings(spark, sf), B.stays(spark, sf), B.traits(spark), B.aliases(spark),
                            B.units(spark), B.linkage(spark, sf), B.questionnaire(spark, sf), B.AS_OF)
    pipe_plan = plan_text(pipe)
    rows.append(("quant_pipeline", summary(pipe_plan)))
    from traitflow.operators import intervals as IV
    rows.append(("admission_windows (unstaged: both sweeps)", summary(plan_text(IV.admission_windows(B.stays(spark, sf))))))
    for k in KEYS:
        rows.append((k, summary(plan_text(C.QUERIES[k](spark, sf)))))
    for k in OUTPUT_KEYS:
        rows.append((k + " (reads the staged tiled table)", summary(plan_text(C.QUERIES[k](spark, sf)))))
    cols = list(rows[0][1])
    out = ["# Physical plans", "",
           f"Generated by `scripts/plan_report.py` on `{sf}` (AQE initial plans; no join carries a hint, so broadcasts",
           "are Spark's choice from the size of the side).", "",
           "| query | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    for name, s in rows:
        out.append(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    out += ["", "## quant_pipeline operator tree", "", "```",
            pipe_plan.split("\n\n(1)")[0].replace("== Physical Plan ==\n", "").rstrip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print("\n".join(out[:len(rows) + 8]))


if __name__ == "__main__":
    main()
