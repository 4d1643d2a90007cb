"""Named feature-candidate registry.

A candidate is a plain ``DataFrame -> DataFrame`` callable registered under a
name and applied with ``DataFrame.transform`` — candidates are code in the
package, never text that gets executed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators import features as FE

FeatureFn = Callable[[DataFrame], DataFrame]
CANDIDATES: dict[str, FeatureFn] = {}


def candidate(name: str):
    def deco(fn: FeatureFn) -> FeatureFn:
        CANDIDATES[name] = fn
        return fn
    return deco


def apply_candidate(df: DataFrame, name: str) -> DataFrame:
    return df.transform(CANDIDATES[name])


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns a candidate added."""
    return [c for c in after.columns if c not in set(before.columns)]


# ---- candidates drawn from the specified feature formulas (G-rows) --------------------
def _vault(name: str) -> FeatureFn:
    def fn(df: DataFrame) -> DataFrame:
        return df.withColumn(name, FE.vault_features(df)[name])
    return fn


for _n in ("compulsive_checking_velocity", "circadian_dopamine_strain", "B_ISAT", "H_AF", "CDUR",
           "dopamine_chasing_index", "nocturnal_displacement_risk", "WESI"):
    CANDIDATES[_n] = _vault(_n)


@candidate("noop")
def _noop(df: DataFrame) -> DataFrame:
    """Adds nothing (exercises the C5 'no new column' gate)."""
    return df


@candidate("screen_social_interaction")
def _interaction(df: DataFrame) -> DataFrame:
    return df.withColumn("screen_social_interaction",
                         F.col("daily_screen_time_hours") * F.col("social_media_hours"))
