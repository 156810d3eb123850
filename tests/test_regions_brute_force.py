"""Hospital regions end to end against a plain-Python reading of the rules, on random stays."""
import datetime as dt
import random

from traitflow.operators import intervals as IV
from traitflow.operators import regions as RG

ORDER = ["APC", "buffer_before", "buffer_after"]


def merge(rows):
    """Boundary split + containment + island merge (rows: (id, s, e, label))."""
    out = []
    for pid in sorted({r[0] for r in rows}):
        iv = [r for r in rows if r[0] == pid]
        pts = sorted({x for r in iv for x in (r[1], r[2]) if x is not None})
        segs = []
        for s, e in zip(pts, pts[1:]):
            labels = {lab for (_, a, b, lab) in iv if b is not None and a <= s and e <= b}
            if labels:
                segs.append([s, e, tuple(x for x in ORDER if x in labels)])
        merged = []
        for s, e, lab in segs:
            if merged and merged[-1][1] == s and merged[-1][2] == lab:
                merged[-1][1] = e
            else:
                merged.append([s, e, lab])
        out += [(pid, s, e, lab) for s, e, lab in merged]
    return out


def round_day(ts):
    return (ts + dt.timedelta(hours=12)).date()


def regions_by_rules(stays, points):
    stays1 = merge([(p, a, d, "APC") for p, a, d in stays])
    kept = [(p, round_day(s), round_day(e)) for p, s, e, _ in stays1 if (round_day(e) - round_day(s)).days > 2]
    buf = []
    for p, s, e in kept:
        buf += [(p, s - dt.timedelta(days=14), s, "buffer_before"), (p, s, e, "APC"),
                (p, e, e + dt.timedelta(days=14), "buffer_after")]
    segs = merge(buf)
    out = {}
    for p, d in points:
        hit = [lab for q, s, e, lab in segs if q == p and s <= d < e]
        out[(p, d)] = hit[0] if hit else None
    return out


def test_regions_match_rules_on_random_stays(spark):
    rnd = random.Random(17)
    base = dt.datetime(2020, 1, 1)
    stays, points = [], []
    for p in [f"p{i}" for i in range(12)]:
        for _ in range(rnd.randint(0, 6)):
            a = base + dt.timedelta(days=rnd.randint(0, 90))
            d = None if rnd.random() < 0.1 else a + dt.timedelta(days=rnd.randint(-1, 9), hours=23, minutes=59,
                                                                      seconds=59)
            stays.append((p, a, d))
        points += [(p, (base + dt.timedelta(days=k)).date()) for k in range(-20, 120, 3)]
    sdf = spark.createDataFrame(stays, "pseudo_nhs_number string, hospital_admission_datetime timestamp_ntz, "
                                       "hospital_discharge_datetime timestamp_ntz")
    pdf = spark.createDataFrame(points, "pseudo_nhs_number string, test_date date")
    segs = IV.admission_windows(sdf)
    want = regions_by_rules(stays, points)
    for via in (False, True):
        got = {(r[0], r[1]): (tuple(r[2]) if r[2] is not None else None)
               for r in RG.add_region_types(pdf, segs, via_lookup=via).select(
                   "pseudo_nhs_number", "test_date", "region_types").collect()}
        assert got == want
