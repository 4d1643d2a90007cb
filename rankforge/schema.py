"""The behaviour-table preset: schema, bounds, vocabularies and constants.

FIXED VALUES — these must equal the values the original pipeline uses for
results to agree; they are stated plainly, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: column names -------------------------------------------------
ID = "id"
LABEL = "addicted_label"

NUMERIC_COLUMNS = [
    "age",
    "daily_screen_time_hours",
    "social_media_hours",
    "gaming_hours",
    "work_study_hours",
    "sleep_hours",
    "notifications_per_day",
    "app_opens_per_day",
    "weekend_screen_time",
]
CATEGORICAL_COLUMNS = ["gender", "stress_level", "academic_work_impact"]

# column order of the behaviour table
BEHAVIOUR_COLUMNS = [
    "age",
    "gender",
    "daily_screen_time_hours",
    "social_media_hours",
    "gaming_hours",
    "work_study_hours",
    "sleep_hours",
    "notifications_per_day",
    "app_opens_per_day",
    "weekend_screen_time",
    "stress_level",
    "academic_work_impact",
]

# ---- fixed values: inclusive bounds, null allowed (None = unbounded) ------------
BOUNDS = {
    "age": (10.0, 120.0),
    "daily_screen_time_hours": (0.0, 24.0),
    "social_media_hours": (0.0, 24.0),
    "gaming_hours": (0.0, 24.0),
    "work_study_hours": (0.0, 24.0),
    "sleep_hours": (0.0, 24.0),
    "notifications_per_day": (0.0, None),
    "app_opens_per_day": (0.0, None),
    "weekend_screen_time": (0.0, 48.0),
}

# ---- fixed values: order of the stress levels ------------------------------------
STRESS_ORDINAL = {"Low": 1, "Medium": 2, "High": 3}

# ---- fixed values: encoder settings ---------------------------------------------
TE_SMOOTHING = 20.0
TE_PAIRS = [
    ("gender", "stress_level"),
    ("gender", "academic_work_impact"),
    ("stress_level", "academic_work_impact"),
]
TE_MISSING = "__missing__"
LABEL_MISSING = "Missing"
MODE_MISSING = "Unknown"

# ---- fixed values: numeric constants --------------------------------------------
FEATURE_EPS = 1e-5
GAUSS_CLIP = 1e-6
LOGLOSS_CLIP = 1e-7
KS_THRESHOLD = 0.05
PROMOTION_DELTA = 0.0003
FAILED_CANDIDATE_DELTA = -0.01
HARD_RESIDUAL = 0.5

# ---- schema -----------------------------------------------------------------------
BEHAVIOUR_SCHEMA = T.StructType(
    [T.StructField(ID, T.LongType(), False)]
    + [
        T.StructField(c, T.StringType() if c in CATEGORICAL_COLUMNS else T.DoubleType(), True)
        for c in BEHAVIOUR_COLUMNS
    ]
    + [T.StructField(LABEL, T.IntegerType(), True)]
)
