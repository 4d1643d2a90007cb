"""Row-local feature projections: the behaviour preset (F1-F16) and the
specified-but-absent formulas (G1-G4, G6-G13, G16-G20).

Every output is a pure Column expression, so a whole preset is one ``select``
that Catalyst fuses into a single whole-stage-codegen Project right after the
scan.  Null in => null out unless a coalesce is written.  Fitted features
(G5, G14, G15) live in ``operators.encode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.columns import (budget_residual, clip, div_or_null, floor_at, lit,
                                         null_count, residual, safe_ratio, sigmoid, strict_ratio)
from rankforge.schema import FEATURE_EPS, NUMERIC_COLUMNS, STRESS_ORDINAL
from rankforge.sources.tables import col_or_null

ENGINEERED = [
    "other_screen", "unaccounted_hours", "UTL", "UTL_ratio", "gaming_to_screen_ratio",
    "social_to_screen_ratio", "screen_to_sleep_ratio", "notifications_per_hour",
    "app_opens_per_hour", "compulsive_pull_ratio", "weekend_screen_time_ratio", "sleep_deficit",
    "productive_work_ratio", "work_adjusted_screen_load", "work_shield_factor",
    "missing_features_count",
]


def _raw(df: DataFrame):
    n = {k: col_or_null(df, k) for k in NUMERIC_COLUMNS}
    return (n["daily_screen_time_hours"], n["social_media_hours"], n["gaming_hours"],
            n["work_study_hours"], n["sleep_hours"], n["notifications_per_day"],
            n["app_opens_per_day"], n["weekend_screen_time"])


def behaviour_features(df: DataFrame, eps: float = FEATURE_EPS) -> dict[str, Column]:
    """F1-F16 as a name -> Column mapping (B2 coercion applied to raw inputs)."""
    scr, soc, gam, wrk, slp, ntf, app, wkd = _raw(df)
    utl = residual(scr, [soc, gam, wrk])
    present = [c for c in NUMERIC_COLUMNS if c in df.columns]
    return {
        "other_screen": residual(scr, [soc, gam, wrk], zero_fill=True),
        "unaccounted_hours": budget_residual(24.0, [scr, wrk, slp]),
        "UTL": utl,
        "UTL_ratio": safe_ratio(utl, scr, eps),
        "gaming_to_screen_ratio": safe_ratio(gam, scr, eps),
        "social_to_screen_ratio": safe_ratio(soc, scr, eps),
        "screen_to_sleep_ratio": safe_ratio(scr, slp, eps),
        "notifications_per_hour": safe_ratio(ntf, scr, eps),
        "app_opens_per_hour": safe_ratio(app, scr, eps),
        "compulsive_pull_ratio": div_or_null(app, ntf + lit(1.0)),
        "weekend_screen_time_ratio": safe_ratio(wkd, scr, eps),
        "sleep_deficit": lit(8.0) - slp,
        "productive_work_ratio": safe_ratio(wrk, scr, eps),
        "work_adjusted_screen_load": div_or_null(scr - F.coalesce(wrk, lit(0.0)), slp + lit(eps)),
        "work_shield_factor": safe_ratio(wrk, scr, eps) * F.exp(-(soc + gam) / lit(2.0)),
        "missing_features_count": null_count([F.col(c) for c in present]),
    }


def engineer(df: DataFrame, eps: float = FEATURE_EPS) -> DataFrame:
    """``preprocess_and_engineer``: input columns + the 16 engineered ones (one Project)."""
    return df.withColumns(behaviour_features(df, eps))


def vault_features(df: DataFrame, eps: float = FEATURE_EPS) -> dict[str, Column]:
    """Formulas specified in the feature vault / reviews."""
    scr, soc, gam, wrk, slp, ntf, app, wkd = _raw(df)
    leisure = soc + gam
    awake = clip(lit(24.0) - slp, 4.0, 20.0)
    act = soc + gam + wrk
    shares = [div_or_null(x, act) for x in (soc, gam, wrk)]
    entropy = -(shares[0] * F.ln(shares[0] + lit(1e-6))
                + shares[1] * F.ln(shares[1] + lit(1e-6))
                + shares[2] * F.ln(shares[2] + lit(1e-6)))
    stress = F.col("stress_level") if "stress_level" in df.columns else F.lit(None).cast("string")
    ordinal = F.when(stress == "Low", lit(STRESS_ORDINAL["Low"])) \
               .when(stress == "Medium", lit(STRESS_ORDINAL["Medium"])) \
               .when(stress == "High", lit(STRESS_ORDINAL["High"]))
    return {
        # G1
        "compulsive_checking_velocity": div_or_null(ntf, app + lit(1.0)) * div_or_null(scr, lit(24.0) - slp),
        # G2
        "circadian_dopamine_strain": div_or_null(floor_at(lit(8.0) - slp, 0.0)
                                                 * F.pow(leisure, lit(1.5)), slp + lit(1.0)),
        # G3, G4
        "synthetic_budget_deficit": (soc + gam + wrk) - scr,
        "synthetic_budget_violation": ((soc + gam + wrk) > scr).cast("int"),
        # G6
        "B_ISAT": div_or_null(div_or_null(app, scr + lit(1e-6)), ntf + lit(1e-6)),
        # G7
        "H_AF": entropy,
        # G8
        "CDUR": div_or_null(soc + gam, wrk + lit(1e-6)) * div_or_null(lit(24.0), slp + lit(1e-6)),
        # G9
        "dopamine_chasing_index": F.log1p(div_or_null(app, ntf + lit(1.0))) * sigmoid(soc + gam - lit(3.0)),
        # G10
        "compulsive_checking_density": div_or_null(app + ntf, lit(24.0) - slp)
                                        * div_or_null(lit(1.0), scr + lit(1e-6)),
        # G12
        "sigmoid_inflection_6h": lit(1.0) / (lit(1.0) + F.exp(lit(-3.0) * (scr - lit(6.25)))),
        "sigmoid_inflection_8h": lit(1.0) / (lit(1.0) + F.exp(lit(-4.0) * (scr - lit(8.0)))),
        "screen_extreme_flag": (scr >= lit(9.5)).cast("int"),
        "screen_safe_flag": (scr <= lit(3.5)).cast("int"),
        # G13
        "awake_hours": awake,
        "leisure_to_awake_ratio": leisure / awake,
        "screen_to_awake_ratio": scr / awake,
        "nocturnal_displacement_risk": floor_at((scr + wrk) - awake, 0.0),
        # G16
        "screen_x_social": scr * soc,
        "screen_per_awake_budget": div_or_null(scr, lit(24.0) - slp),
        # G17
        "WESI": div_or_null(wkd - scr, scr + lit(eps)) * ordinal,
        "sleep_displacement": lit(24.0) - slp - wrk,
        # G19
        "strict_social_to_screen": strict_ratio(soc, scr),
    }


def decimal_lattice(df: DataFrame, cols=("daily_screen_time_hours", "social_media_hours",
                                          "gaming_hours", "work_study_hours", "sleep_hours")) -> dict[str, Column]:
    """Fractional part, first decimal digit, distance to integer, exact-half flag."""
    out = {}
    for c in cols:
        s = col_or_null(df, c)
        frac = s - F.floor(s)
        out[f"{c}_frac"] = frac
        out[f"{c}_d1"] = (F.floor(s * lit(10.0)) % 10).cast("int")
        out[f"{c}_dist_int"] = F.abs(s - F.rint(s))
        out[f"{c}_is_exact_half"] = (F.abs(frac - lit(0.5)) < lit(1e-4)).cast("int")
    return out


def missingness(df: DataFrame, cols=None) -> dict[str, Column]:
    """Per-column null flags and a joint (any-null) flag."""
    cols = [c for c in (cols or NUMERIC_COLUMNS) if c in df.columns]
    out = {f"{c}_is_null": F.col(c).isNull().cast("int") for c in cols}
    out["any_null"] = (null_count(cols) > 0).cast("int")
    out["row_null_count"] = null_count(cols)
    return out
