"""Features, cohort analytics, ranks and AUC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.catalog import sqlparts as SP
from rankforge.catalog.base import D, register
from rankforge.functions.columns import rnd, round_doubles
from rankforge.operators import analytics as AN
from rankforge.operators import features as FE
from rankforge.operators import metrics as ME
from rankforge.operators import rank as RK
from rankforge.schema import LABEL
from rankforge.sources.fixture import behaviour_view, scored_view, with_fixture

# =====================================================================================
# F1-F16: feature projection preset
# =====================================================================================
_EPS = SP.EPS
_F_SQL = "SELECT id,\n  " + SP.features_select().replace(
    SP.FEATURE_SQL["work_shield_factor"] + " AS work_shield_factor",
    "round(" + SP.FEATURE_SQL["work_shield_factor"] + ", 6) AS work_shield_factor") + "\nFROM fx"


@register("f01_f16_feature_projection", with_fixture(_F_SQL))
def q_features(spark, sf):
    df = behaviour_view(spark, sf)
    feats = FE.behaviour_features(df)
    out = df.select("id", *[v.alias(k) for k, v in feats.items()])
    return out.withColumn("work_shield_factor", rnd("work_shield_factor", 6))


# =====================================================================================
# Q5-Q7: cohort analytics (conditional means, group risk, rows analysed)
# =====================================================================================
@register("q5_conditional_mean", with_fixture(f"""
SELECT round(avg(CASE WHEN daily_screen_time_hours > {D(6)} THEN {D(LABEL)} END), 4) AS p_addicted_given_high_screen,
       round(avg(CASE WHEN daily_screen_time_hours > {D(6)} AND work_study_hours > {D(5)} THEN {D(LABEL)} END), 4)
         AS p_addicted_given_productive_shield,
       count(*) AS sample_analyzed
FROM fx"""))
def q_cond_mean(spark, sf):
    df = behaviour_view(spark, sf)
    scr, wrk = F.col("daily_screen_time_hours"), F.col("work_study_hours")
    return AN.conditional_means(df, LABEL, {
        "p_addicted_given_high_screen": scr > 6.0,
        "p_addicted_given_productive_shield": (scr > 6.0) & (wrk > 5.0),
    })


@register("q6_group_risk", with_fixture(f"""
SELECT stress_level, count({LABEL}) AS "count", avg({D(LABEL)}) AS "mean"
FROM fx WHERE stress_level IS NOT NULL GROUP BY stress_level"""))
def q_group_risk(spark, sf):
    return AN.group_risk(behaviour_view(spark, sf), "stress_level", LABEL)


@register("q7_row_count", with_fixture("SELECT count(*) AS sample_analyzed FROM fx"))
def q_row_count(spark, sf):
    return behaviour_view(spark, sf).agg(F.count(F.lit(1)).alias("sample_analyzed"))


_COHORT_FEATS = ["daily_screen_time_hours", "sleep_hours", "work_study_hours", "other_screen",
                 "screen_to_sleep_ratio"]


def cohort_risk(spark, sf):
    """Flagship: cohort risk by stress level with feature means."""
    df = FE.engineer(behaviour_view(spark, sf))
    return round_doubles(AN.cohort_profile(df, "stress_level", LABEL, _COHORT_FEATS), 6)


register("cohort_risk_profile", with_fixture(f"""
SELECT stress_level, count({LABEL}) AS "count", round(avg({D(LABEL)}), 6) AS "mean",
  round(avg(daily_screen_time_hours), 6) AS avg_daily_screen_time_hours,
  round(avg(sleep_hours), 6) AS avg_sleep_hours,
  round(avg(work_study_hours), 6) AS avg_work_study_hours,
  round(avg(daily_screen_time_hours - (coalesce(social_media_hours, {D(0)}) + coalesce(gaming_hours, {D(0)}) + coalesce(work_study_hours, {D(0)}))), 6) AS avg_other_screen,
  round(avg(daily_screen_time_hours / (sleep_hours + {_EPS})), 6) AS avg_screen_to_sleep_ratio
FROM fx WHERE stress_level IS NOT NULL GROUP BY stress_level"""))(cohort_risk)


# =====================================================================================
# Ranks;  Q1-Q4: metrics
# =====================================================================================
def _train(spark, sf):
    return scored_view(spark, sf).where(F.col("split") == "train")


@register("w1_average_rank", with_fixture("""
SELECT id, p2,
  CAST(rank() OVER (ORDER BY p2) AS DOUBLE) + (count(*) OVER (PARTITION BY p2) - 1) / 2.0e0 AS p2_avg_rank
FROM sx""", scores=True))
def q_avg_rank(spark, sf):
    df = scored_view(spark, sf).select("id", "p2")
    return RK.with_ranks(df, "p2", kinds=("avg_rank",)).select("id", "p2", "p2_avg_rank")


@register("w2_percentile_rank", with_fixture("""
SELECT id, p3,
  (CAST(rank() OVER (ORDER BY p3) AS DOUBLE) + (count(*) OVER (PARTITION BY p3) - 1) / 2.0e0 - 0.5e0)
    / count(*) OVER () AS p3_pct_rank
FROM sx""", scores=True))
def q_pct_rank(spark, sf):
    df = scored_view(spark, sf).select("id", "p3")
    return RK.with_ranks(df, "p3", kinds=("pct_rank",)).select("id", "p3", "p3_pct_rank")


@register("q1_auc", with_fixture(f"""
, g AS (SELECT p1, count(*) AS n, sum({LABEL}) AS npos FROM sx WHERE split = 'train' GROUP BY p1),
  c AS (SELECT *, n - npos AS nneg,
          coalesce(sum(n - npos) OVER (ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_neg
        FROM g)
SELECT sum(npos * (2.0e0 * before_neg + nneg)) / (2.0e0 * sum(npos) * sum(nneg)) AS auc,
       CAST(sum(npos) AS BIGINT) AS n_pos, CAST(sum(nneg) AS BIGINT) AS n_neg
FROM c""", scores=True))
def q_auc(spark, sf):
    return ME.auc_by(_train(spark, sf), "p1", LABEL)
