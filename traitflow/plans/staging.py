"""Stages written once and read back by every later step, also by later applications.

Mirrors the file barriers of the modelled pipeline (combo, segments, tiled readings): the
expensive prefix runs once, its Parquet output lives in the shared checkpoint folder (so it
survives executor loss and cuts lineage), and the many per-setting / per-trait outputs read
it instead of recomputing it. A restarted driver finds complete stages in the registry
(``plans/registry.py``) under the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from traitflow.plans.registry import StageRegistry, fingerprint
from traitflow.session import checkpoint_root

__all__ = ["fingerprint", "forget", "registry", "staged"]

# What this process has seen, so that a stage is looked up once: (application, key, inputs) -> manifest.
_STAGED: dict[tuple[str, str, str], dict] = {}
_fresh_only = False


def registry(spark: SparkSession) -> StageRegistry:
    return StageRegistry(spark, f"{checkpoint_root(spark)}/traitflow/stages")


def staged(spark: SparkSession, key: str, build: Callable[[], DataFrame], inputs: str = "") -> DataFrame:
    stages, k = registry(spark), (spark.sparkContext.applicationId, key, inputs)
    if k not in _STAGED:
        known = None if _fresh_only else stages.find(key, inputs)
        _STAGED[k] = known or stages.write(key, inputs, build())
    return stages.open(_STAGED[k])


def forget() -> None:
    """Stages written so far, by this application or another one, are not read again by this process."""
    global _fresh_only
    _fresh_only = True
    _STAGED.clear()
