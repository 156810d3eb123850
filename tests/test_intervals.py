import datetime as dt
import random

from traitflow.functions.regions import CATEGORIES
from traitflow.operators import intervals as IV
from traitflow.operators import regions as RG

D = dt.date
ORDER = ["APC", "buffer_before", "buffer_after"]


def brute_force(rows):
    """Boundary split + containment + island merge, written directly from the definition."""
    out = []
    for pid in sorted({r[0] for r in rows}):
        iv = [r for r in rows if r[0] == pid and r[1] is not None]
        pts = sorted({x for r in iv for x in (r[1], r[2]) if x is not None})
        segs = []
        for s, e in zip(pts, pts[1:]):
            labels = {lab for (_, a, b, labs) in iv for lab in labs if b is not None and a <= s and e <= b}
            if labels:
                segs.append([s, e, tuple(x for x in ORDER if x in labels)])
        merged = []
        for s, e, lab in segs:
            if merged and merged[-1][1] == s and merged[-1][2] == lab:
                merged[-1][1] = e
            else:
                merged.append([s, e, lab])
        out += [(pid, s, e, list(lab)) for s, e, lab in merged]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame(rows, "pseudo_nhs_number string, start_date date, end_date date, region_types array<string>")
    got = IV.split_and_remerge_intervals(df).collect()
    return sorted((r[0], r[1], r[2], list(r[3])) for r in got)


def test_edge_cases_match_brute_force(spark):
    rows = [
        ("a", D(2020, 1, 1), D(2020, 1, 10), ["APC"]), ("a", D(2020, 1, 5), D(2020, 1, 20), ["APC"]),   # overlap
        ("b", D(2020, 1, 1), D(2020, 1, 30), ["APC"]), ("b", D(2020, 1, 5), D(2020, 1, 6), ["APC"]),    # nested
        ("c", D(2020, 1, 1), D(2020, 1, 5), ["APC"]), ("c", D(2020, 1, 5), D(2020, 1, 9), ["APC"]),     # touching
        ("d", D(2020, 1, 1), D(2020, 1, 5), ["APC"]), ("d", D(2020, 1, 1), D(2020, 1, 5), ["APC"]),     # identical
        ("e", D(2020, 1, 1), None, ["APC"]), ("e", D(2020, 1, 3), D(2020, 1, 8), ["APC"]),              # null end
        ("f", D(2020, 1, 9), D(2020, 1, 2), ["APC"]),                                                    # end < start
        ("g", D(2020, 1, 1), D(2020, 1, 15), ["buffer_before"]), ("g", D(2020, 1, 15), D(2020, 1, 20), ["APC"]),
        ("g", D(2020, 1, 10), D(2020, 1, 30), ["buffer_after"]),                                         # labels mix
    ]
    assert run(spark, rows) == brute_force(rows)


def test_random_intervals_match_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for pid in "pqrstu":
        for _ in range(rnd.randint(1, 8)):
            s = D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60))
            e = s + dt.timedelta(days=rnd.randint(-2, 20))
            rows.append((pid, s, e if rnd.random() > 0.1 else None, [rnd.choice(ORDER)]))
    got = run(spark, rows)
    assert got == brute_force(rows)
    for pid in "pqrstu":   # disjoint and ordered per person
        segs = [g for g in got if g[0] == pid]
        assert all(a[2] <= b[1] for a, b in zip(segs, segs[1:]))


def test_admission_windows_rules(spark):
    ts = dt.datetime
    rows = [
        ("a", ts(2020, 1, 1), ts(2020, 1, 2, 23, 59, 59)),   # 1 night -> rounds to 2 days -> dropped (> 2 needed)
        ("b", ts(2020, 1, 1), ts(2020, 1, 3, 23, 59, 59)),   # 3 days -> kept
        ("c", ts(2020, 1, 1), ts(2020, 1, 2, 23, 59, 59)),   # adjacent stays are not merged ...
        ("c", ts(2020, 1, 3), ts(2020, 1, 4, 23, 59, 59)),   # ... and each is too short
        ("d", ts(2020, 1, 1), None),                         # null discharge covers nothing
    ]
    stays = spark.createDataFrame(rows, "pseudo_nhs_number string, hospital_admission_datetime timestamp_ntz, "
                                        "hospital_discharge_datetime timestamp_ntz")
    got = sorted((r[0], r[1], r[2], tuple(r[3])) for r in IV.admission_windows(stays).collect())
    assert got == [("b", D(2019, 12, 18), D(2020, 1, 1), ("buffer_before",)),
                   ("b", D(2020, 1, 1), D(2020, 1, 4), ("APC",)),
                   ("b", D(2020, 1, 4), D(2020, 1, 18), ("buffer_after",))]


def test_reading_dates_against_region_edges(spark):
    segs = spark.createDataFrame([("a", D(2019, 12, 18), D(2020, 1, 1), ["buffer_before"]),
                                  ("a", D(2020, 1, 1), D(2020, 1, 4), ["APC"]),
                                  ("a", D(2020, 1, 4), D(2020, 1, 18), ["buffer_after"])],
                                 "pseudo_nhs_number string, start_date date, end_date date, region_types array<string>")
    dates = [D(2019, 12, 17), D(2019, 12, 18), D(2020, 1, 1), D(2020, 1, 3), D(2020, 1, 4), D(2020, 1, 17),
             D(2020, 1, 18)]
    pts = spark.createDataFrame([("a", d) for d in dates] + [("zz", D(2020, 1, 2))],
                                "pseudo_nhs_number string, test_date date")
    for via in (False, True):
        got = {(r[0], r[1]): (None if r[2] is None else tuple(r[2]))
               for r in RG.add_region_types(pts, segs, via_lookup=via).collect()}
        assert got[("a", D(2019, 12, 17))] is None
        assert got[("a", D(2019, 12, 18))] == ("buffer_before",)
        assert got[("a", D(2020, 1, 1))] == ("APC",)
        assert got[("a", D(2020, 1, 3))] == ("APC",)
        assert got[("a", D(2020, 1, 4))] == ("buffer_after",)
        assert got[("a", D(2020, 1, 17))] == ("buffer_after",)
        assert got[("a", D(2020, 1, 18))] is None
        assert got[("zz", D(2020, 1, 2))] is None


def test_eleven_categories_over_all_subsets(spark):
    rows = RG.region_subset_table(spark).collect()
    assert len(rows) == 8
    for r in rows:
        s = set(r["region_types"] or [])
        a, bb, ba = "APC" in s, "buffer_before" in s, "buffer_after" in s
        want = {"IN_APC_ONLY": a and not bb and not ba, "IN_APC_ANY": a,
                "IN_BUFFER_BEFORE_ONLY": bb and not a and not ba, "IN_BUFFER_BEFORE_ANY": bb,
                "IN_BUFFER_AFTER_ONLY": ba and not a and not bb, "IN_BUFFER_AFTER_ANY": ba,
                "IN_BUFFERS_ONLY": (bb or ba) and not a, "IN_BUFFERS_ANY": bb or ba,
                "IN_TOTAL_EXCLUSION_ZONE": a or bb or ba, "OUT_OF_APC": not a,
                "OUT_OF_TOTAL_EXCLUSION_ZONE": not (a or bb or ba)}
        assert {c: r[c] for c in CATEGORIES} == want


def test_settings_partition_all(spark):
    df = spark.createDataFrame([(1, None), (2, ["APC"]), (3, ["buffer_after"])], "id int, region_types array<string>")
    got = sorted((r[0], r[1]) for r in RG.setting_split(df).select("id", "setting").collect())
    assert got == [(1, "all"), (1, "out_hospital"), (2, "all"), (2, "in_hospital"), (3, "all"), (3, "in_hospital")]
