"""Region predicates over a ``region_types`` array (null = outside every stay and buffer).

Every predicate is null-safe and returns a non-null boolean, so a reading with no region
is OUT_OF_APC and OUT_OF_TOTAL_EXCLUSION_ZONE and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitflow import schema as S

# The eleven categories, in their documented order.
CATEGORIES = [
    "IN_APC_ONLY", "IN_APC_ANY", "IN_BUFFER_BEFORE_ONLY", "IN_BUFFER_BEFORE_ANY",
    "IN_BUFFER_AFTER_ONLY", "IN_BUFFER_AFTER_ANY", "IN_BUFFERS_ONLY", "IN_BUFFERS_ANY",
    "IN_TOTAL_EXCLUSION_ZONE", "OUT_OF_APC", "OUT_OF_TOTAL_EXCLUSION_ZONE",
]


def has(regions: Column | str, label: str) -> Column:
    r = F.col(regions) if isinstance(regions, str) else regions
    return F.coalesce(F.array_contains(r, F.lit(label)), F.lit(False))


def category(regions: Column | str, name: str) -> Column:
    a = has(regions, "APC")
    bb = has(regions, "buffer_before")
    ba = has(regions, "buffer_after")
    return {
        "IN_APC_ONLY": a & ~bb & ~ba,
        "IN_APC_ANY": a,
        "IN_BUFFER_BEFORE_ONLY": bb & ~a & ~ba,
        "IN_BUFFER_BEFORE_ANY": bb,
        "IN_BUFFER_AFTER_ONLY": ba & ~a & ~bb,
        "IN_BUFFER_AFTER_ANY": ba,
        "IN_BUFFERS_ONLY": (bb | ba) & ~a,
        "IN_BUFFERS_ANY": bb | ba,
        "IN_TOTAL_EXCLUSION_ZONE": a | bb | ba,
        "OUT_OF_APC": ~a,
        "OUT_OF_TOTAL_EXCLUSION_ZONE": ~(a | bb | ba),
    }[name]


def canonical_regions(a: Column, bb: Column, ba: Column) -> Column:
    """Array of the labels whose flag is true, in canonical order; null when none."""
    arr = F.filter(
        F.array(
            F.when(a, F.lit(S.REGION_ORDER[0])),
            F.when(bb, F.lit(S.REGION_ORDER[1])),
            F.when(ba, F.lit(S.REGION_ORDER[2])),
        ),
        lambda x: x.isNotNull(),
    )
    return F.when(F.size(arr) > 0, arr)


def settings_of(regions: Column | str) -> Column:
    """The output settings a reading belongs to: its hospital side plus ``all``."""
    inside = category(regions, "IN_TOTAL_EXCLUSION_ZONE")
    return F.when(inside, F.array(F.lit("in_hospital"), F.lit("all"))).otherwise(
        F.array(F.lit("out_hospital"), F.lit("all")))
