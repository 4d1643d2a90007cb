"""Reusable SQL fragments for the DuckDB oracles (same formulas as the operators)."""

from __future__ import annotations

from rankforge.catalog.base import D
from rankforge.schema import LABEL

EPS = "CAST(1e-5 AS DOUBLE)"
SCR, SOC, GAM, WRK, SLP = ("daily_screen_time_hours", "social_media_hours", "gaming_hours",
                           "work_study_hours", "sleep_hours")
NTF, APP, WKD = "notifications_per_day", "app_opens_per_day", "weekend_screen_time"
RAW_NUMERIC = ["age", SCR, SOC, GAM, WRK, SLP, NTF, APP, WKD]

FEATURE_SQL = {
    "other_screen": f"{SCR} - (coalesce({SOC}, {D(0)}) + coalesce({GAM}, {D(0)}) + coalesce({WRK}, {D(0)}))",
    "unaccounted_hours": f"{D(24)} - ({SCR} + {WRK} + {SLP})",
    "UTL": f"{SCR} - ({SOC} + {GAM} + {WRK})",
    "UTL_ratio": f"({SCR} - ({SOC} + {GAM} + {WRK})) / ({SCR} + {EPS})",
    "gaming_to_screen_ratio": f"{GAM} / ({SCR} + {EPS})",
    "social_to_screen_ratio": f"{SOC} / ({SCR} + {EPS})",
    "screen_to_sleep_ratio": f"{SCR} / ({SLP} + {EPS})",
    "notifications_per_hour": f"{NTF} / ({SCR} + {EPS})",
    "app_opens_per_hour": f"{APP} / ({SCR} + {EPS})",
    "compulsive_pull_ratio": f"{APP} / ({NTF} + {D(1)})",
    "weekend_screen_time_ratio": f"{WKD} / ({SCR} + {EPS})",
    "sleep_deficit": f"{D(8)} - {SLP}",
    "productive_work_ratio": f"{WRK} / ({SCR} + {EPS})",
    "work_adjusted_screen_load": f"({SCR} - coalesce({WRK}, {D(0)})) / ({SLP} + {EPS})",
    "work_shield_factor": f"{WRK} / ({SCR} + {EPS}) * exp(-({SOC} + {GAM}) / {D(2)})",
    "missing_features_count": "CAST(" + " + ".join(f"({c} IS NULL)::INT" for c in RAW_NUMERIC) + " AS INTEGER)",
}


def features_select(prefix: str = "") -> str:
    return ",\n  ".join(f"{expr} AS {prefix}{name}" for name, expr in FEATURE_SQL.items())


def md5_key(seed_sql: str, key: str = "id") -> str:
    return f"md5({seed_sql} || ':' || CAST({key} AS VARCHAR))"


def folds_cte(k: int = 5, seed: int = 42, source: str = "tr", name: str = "fo") -> str:
    """S1 in SQL: fold = (row_number by md5 order within label - 1) % k."""
    return (f"{name} AS (SELECT *, CAST((row_number() OVER (PARTITION BY {LABEL} "
            f"ORDER BY {md5_key(repr(str(seed)))}, id) - 1) % {k} AS INTEGER) AS fold FROM {source})")


def avg_rank(col: str, part: str = "") -> str:
    """Single-window average-tie rank (oracle form of W1)."""
    p = f"PARTITION BY {part} " if part else ""
    p2 = f"{part}, " if part else ""
    return (f"(CAST(rank() OVER ({p}ORDER BY {col}) AS DOUBLE) "
            f"+ (count(*) OVER (PARTITION BY {p2}{col}) - 1) / 2.0e0)")


def pct_rank(col: str, part: str = "") -> str:
    p = f"PARTITION BY {part}" if part else ""
    return f"(({avg_rank(col, part)} - 0.5e0) / count(*) OVER ({p}))"
