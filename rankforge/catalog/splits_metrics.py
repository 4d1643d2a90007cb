"""Sampling/splitting (S1-S4, B10), Gauss rank (W3), metrics (Q2-Q4, Q8-Q15), drift gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from rankforge.catalog import sqlparts as SP
from rankforge.catalog.base import D, register
from rankforge.functions.columns import rnd, round_doubles
from rankforge.functions.normal import probit_sql
from rankforge.operators import analytics as AN
from rankforge.operators import features as FE
from rankforge.operators import metrics as ME
from rankforge.operators import rank as RK
from rankforge.operators import sampling as SA
from rankforge.session import stored
from rankforge.schema import KS_THRESHOLD, LABEL, NUMERIC_COLUMNS
from rankforge.sources.fixture import behaviour_view, scored_view, with_fixture

K, SEED = 5, 42
_TR = ", tr AS (SELECT * FROM sx WHERE split = 'train')"
_FO = f", {SP.folds_cte(K, SEED)}"


def train_rows(spark, sf):
    return scored_view(spark, sf).where(F.col("split") == "train")


def train_folds(spark, sf):
    return SA.stratified_folds(train_rows(spark, sf), K, LABEL, seed=SEED)


# ---------------------------------------------------------------------------------
# S1-S4, B10
# ---------------------------------------------------------------------------------
@register("s1_stratified_kfold", with_fixture(_TR + _FO + f"\nSELECT id, {LABEL}, fold FROM fo", scores=True))
def q_s1(spark, sf):
    return train_folds(spark, sf).select("id", LABEL, "fold")


_S2_SQL = _TR + f"""
, cls AS (SELECT {LABEL}, count(*) AS nc FROM tr GROUP BY {LABEL}),
  q1 AS (SELECT *, sum(nc) OVER () AS "N", ceil(0.3e0 * sum(nc) OVER ()) AS nsel FROM cls),
  q2 AS (SELECT *, nsel * nc / "N" AS ex FROM q1),
  q3 AS (SELECT *, floor(ex) AS base, ex - floor(ex) AS rem FROM q2),
  q4 AS (SELECT *, nsel - sum(base) OVER () AS lft,
                row_number() OVER (ORDER BY rem DESC, {LABEL}) AS ord FROM q3),
  quota AS (SELECT {LABEL}, base + CASE WHEN ord <= lft THEN 1 ELSE 0 END AS quota FROM q4),
  rk AS (SELECT id, {LABEL}, row_number() OVER (PARTITION BY {LABEL} ORDER BY {SP.md5_key("'42'")}, id) AS rnk FROM tr)
SELECT rk.id, rk.{LABEL} FROM rk JOIN quota USING ({LABEL}) WHERE rnk <= quota"""


@register("s2_stratified_downsample", with_fixture(_S2_SQL, scores=True))
def q_s2(spark, sf):
    return SA.stratified_downsample(train_rows(spark, sf), 0.3, LABEL, seed=SEED).select("id", LABEL)


@register("s3_seeded_sample", with_fixture(f"""
SELECT id, {LABEL} FROM fx ORDER BY {SP.md5_key("'42'")}, id LIMIT 1000"""))
def q_s3(spark, sf):
    return SA.seeded_sample(behaviour_view(spark, sf), 1000, seed=SEED).select("id", LABEL)


@register("s4_nested_folds", with_fixture(_TR + _FO + f"""
, parts AS (SELECT fo.id, fo.{LABEL}, o.outer_fold FROM fo
            JOIN (SELECT CAST(unnest(range({K})) AS INTEGER) AS outer_fold) o ON fo.fold <> o.outer_fold)
SELECT id, outer_fold,
  CAST((row_number() OVER (PARTITION BY outer_fold, {LABEL}
        ORDER BY {SP.md5_key(f"CAST({SEED} + outer_fold AS VARCHAR)")}, id) - 1) % {K} AS INTEGER) AS inner_fold
FROM parts""", scores=True))
def q_s4(spark, sf):
    return SA.nested_folds(train_folds(spark, sf), K, K, LABEL, seed=SEED).select("id", "outer_fold", "inner_fold")


@register("b10_fold_split", with_fixture(_TR + _FO + f"""
SELECT CAST(k AS INTEGER) AS fold, CASE WHEN fold = k THEN 'validation' ELSE 'train' END AS part,
       count(*) AS n, CAST(sum({LABEL}) AS BIGINT) AS npos
FROM fo CROSS JOIN range({K}) r(k) GROUP BY 1, 2""", scores=True))
def q_b10(spark, sf):
    """Both sides of every fold's split."""
    folds = stored(train_folds(spark, sf).select("id", "fold", LABEL), "folds")
    agg = [F.count(F.lit(1)).alias("n"), F.sum(LABEL).cast("long").alias("npos")]
    sides = [side.agg(*agg).select(F.lit(k).alias("fold"), F.lit(name).alias("part"), "n", "npos")
             for k in range(K) for name, side in zip(("train", "validation"), SA.fold_split(folds, k))]
    return reduce(lambda a, b: a.unionByName(b), sides)


# ---------------------------------------------------------------------------------
# Gauss rank
# ---------------------------------------------------------------------------------
@register("w3_gauss_rank", with_fixture(f"""
SELECT id, p1, round({probit_sql(f"least(greatest({SP.pct_rank('p1')}, 1e-6), 1.0e0 - 1e-6)")}, 6) AS p1_gauss_rank
FROM sx""", scores=True))
def q_w3(spark, sf):
    df = scored_view(spark, sf).select("id", "p1")
    out = RK.with_ranks(df, "p1", kinds=("gauss_rank",))
    return out.select("id", "p1", rnd("p1_gauss_rank", 6).alias("p1_gauss_rank"))


# ---------------------------------------------------------------------------------
# Q2: per-fold AUC and mean;  Q3 log loss;  Q4/C3 KS drift
# ---------------------------------------------------------------------------------
_Q2_SQL = _TR + _FO + f"""
, g AS (SELECT fold, p2, count(*) AS n, sum({LABEL}) AS npos FROM fo GROUP BY fold, p2),
  c AS (SELECT *, n - npos AS nneg,
          coalesce(sum(n - npos) OVER (PARTITION BY fold ORDER BY p2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_neg
        FROM g),
  fa AS (SELECT fold, sum(npos * (2.0e0 * before_neg + nneg)) / (2.0e0 * sum(npos) * sum(nneg)) AS auc,
           CAST(sum(npos) AS BIGINT) AS n_pos, CAST(sum(nneg) AS BIGINT) AS n_neg FROM c GROUP BY fold)
"""


@register("q2_fold_auc", with_fixture(_Q2_SQL + "SELECT * FROM fa", scores=True))
def q_q2(spark, sf):
    return ME.auc_by(train_folds(spark, sf), "p2", LABEL, ["fold"])


@register("q2_mean_fold_auc", with_fixture(_Q2_SQL + """
SELECT round(avg(auc), 6) AS mean_auc, round(stddev_pop(auc), 6) AS std_auc, count(*) AS n_folds FROM fa""",
                                           scores=True))
def q_q2_mean(spark, sf):
    return round_doubles(ME.mean_fold_auc(ME.auc_by(train_folds(spark, sf), "p2", LABEL, ["fold"])))


@register("q12_fold_score_stats", with_fixture(_Q2_SQL + """
SELECT round(avg(auc), 6) AS mean_score, round(stddev_pop(auc), 6) AS std_score FROM fa""", scores=True))
def q_q12(spark, sf):
    fa = ME.auc_by(train_folds(spark, sf), "p2", LABEL, ["fold"])
    return round_doubles(AN.fold_score_stats(fa, "auc"))


@register("q3_log_loss", with_fixture(f"""
SELECT round(avg(-({D(LABEL)} * ln(least(greatest(p1, 1e-7), 1.0e0 - 1e-7))
                + (1.0e0 - {D(LABEL)}) * ln(1.0e0 - least(greatest(p1, 1e-7), 1.0e0 - 1e-7)))), 6) AS log_loss
FROM sx WHERE split = 'train'""", scores=True))
def q_q3(spark, sf):
    return round_doubles(ME.log_loss(train_rows(spark, sf), "p1", LABEL))


_KS_SQL = """
, st AS (SELECT CASE WHEN split = 'test' THEN 1 ELSE 0 END AS b, model, value
         FROM (UNPIVOT (SELECT split, p1, p2, p3, p4, (p1 + p2 + p3 + p4) / 4.0e0 AS blend FROM sx)
               ON p1, p2, p3, p4, blend INTO NAME model VALUE value)),
  g AS (SELECT model, value, sum(1 - b) AS na, sum(b) AS nb FROM st GROUP BY model, value),
  c AS (SELECT model, value,
          sum(na) OVER (PARTITION BY model ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca,
          sum(nb) OVER (PARTITION BY model ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cb,
          sum(na) OVER (PARTITION BY model) AS ta, sum(nb) OVER (PARTITION BY model) AS tb FROM g),
  ks AS (SELECT model, max(abs(ca / CAST(ta AS DOUBLE) - cb / CAST(tb AS DOUBLE))) AS ks_stat,
           CAST(max(ta) AS BIGINT) AS n_a, CAST(max(tb) AS BIGINT) AS n_b FROM c GROUP BY model)
"""


def _ks(spark, sf):
    df = scored_view(spark, sf).withColumn("blend", (F.col("p1") + F.col("p2") + F.col("p3") + F.col("p4"))
                                           / F.lit(4.0))
    long = ME.stack_scores(df.withColumn("b", (F.col("split") == "test").cast("int")),
                           ["p1", "p2", "p3", "p4", "blend"], ["b"])
    return ME.ks_2samp(long, "value", "b", ["model"])


@register("q4_ks_statistic", with_fixture(_KS_SQL + "SELECT * FROM ks", scores=True))
def q_q4(spark, sf):
    return _ks(spark, sf)


@register("c3_drift_gate", with_fixture(_KS_SQL + f"""
SELECT model, ks_stat, ks_stat <= {KS_THRESHOLD}e0 AS passed FROM ks""", scores=True))
def q_c3(spark, sf):
    return ME.drift_gate(_ks(spark, sf), KS_THRESHOLD).select("model", "ks_stat", "passed")


# ---------------------------------------------------------------------------------
# Residual analytics on fixture score p1
# ---------------------------------------------------------------------------------
@register("q8_abs_residual", with_fixture(f"SELECT id, abs({D(LABEL)} - p1) AS residual FROM sx", scores=True))
def q_q8(spark, sf):
    return AN.absolute_residual(scored_view(spark, sf), LABEL, "p1").select("id", "residual")


@register("q9_hard_samples", with_fixture(f"""
SELECT count(*) FILTER (WHERE abs({D(LABEL)} - p1) > 0.5e0) AS n_hard,
       round(avg(CASE WHEN abs({D(LABEL)} - p1) > 0.5e0 THEN 1.0e0 ELSE 0.0e0 END), 6) AS hard_rate,
       count(*) AS n_rows FROM sx""", scores=True))
def q_q9(spark, sf):
    return round_doubles(AN.hard_samples(AN.absolute_residual(scored_view(spark, sf), LABEL, "p1")))


_CORR_COLS = NUMERIC_COLUMNS + list(SP.FEATURE_SQL)


def _corr_sql(top: int | None = None) -> str:
    feats = ", ".join(f"{expr} AS {name}" for name, expr in SP.FEATURE_SQL.items())
    parts = []
    for c in _CORR_COLS:
        parts.append(f"SELECT '{c}' AS feature, corr(coalesce(CAST({c} AS DOUBLE), "
                     f"(SELECT median(CAST({c} AS DOUBLE)) FROM fe)), residual) AS corr FROM fe")
    body = f"""
, fe AS (SELECT *, {feats}, abs({D(LABEL)} - p1) AS residual FROM sx),
  cr AS ({' UNION ALL '.join(parts)})
"""
    if top is None:
        return body + "SELECT feature, round(corr, 6) AS corr FROM cr WHERE corr IS NOT NULL AND NOT isnan(corr)"
    return body + (f"SELECT feature, round(corr, 6) AS corr FROM cr WHERE corr IS NOT NULL AND NOT isnan(corr) "
                   f"ORDER BY abs(corr) DESC, feature LIMIT {top}")


def _residual_frame(spark, sf):
    return AN.absolute_residual(FE.engineer(scored_view(spark, sf)), LABEL, "p1")


@register("q10_residual_correlation", with_fixture(_corr_sql(), scores=True))
def q_q10(spark, sf):
    return round_doubles(AN.residual_correlations(_residual_frame(spark, sf), _CORR_COLS))


@register("j5_top_abs_correlation", with_fixture(_corr_sql(10), scores=True))
def q_j5(spark, sf):
    corr = round_doubles(AN.residual_correlations(_residual_frame(spark, sf), _CORR_COLS))
    return corr.orderBy(F.abs("corr").desc(), F.col("feature")).limit(10)


@register("q11_error_profile", with_fixture(f"""
SELECT error_type, count(*) AS n, round(avg({SP.SCR}), 6) AS mean_{SP.SCR},
       round(avg({SP.SLP}), 6) AS mean_{SP.SLP}, round(avg({SP.WRK}), 6) AS mean_{SP.WRK}
FROM (SELECT *, CASE WHEN {LABEL} = 0 AND p1 > 0.5e0 THEN 'FP' WHEN {LABEL} = 1 AND p1 <= 0.5e0 THEN 'FN' END AS error_type
      FROM sx) WHERE error_type IS NOT NULL GROUP BY error_type""", scores=True))
def q_q11(spark, sf):
    return round_doubles(AN.error_profile(scored_view(spark, sf), LABEL, "p1", [SP.SCR, SP.SLP, SP.WRK]))


_AUC4_SQL = f"""
, st AS (SELECT {LABEL}, model, value FROM (UNPIVOT (SELECT {LABEL}, p1, p2, p3, p4 FROM sx WHERE split = 'train')
         ON p1, p2, p3, p4 INTO NAME model VALUE value)),
  g AS (SELECT model, value, count(*) AS n, sum({LABEL}) AS npos FROM st GROUP BY model, value),
  c AS (SELECT *, n - npos AS nneg,
          coalesce(sum(n - npos) OVER (PARTITION BY model ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_neg
        FROM g),
  ma AS (SELECT model, sum(npos * (2.0e0 * before_neg + nneg)) / (2.0e0 * sum(npos) * sum(nneg)) AS auc,
           CAST(sum(npos) AS BIGINT) AS n_pos, CAST(sum(nneg) AS BIGINT) AS n_neg FROM c GROUP BY model)
"""


def model_aucs(spark, sf):
    return ME.auc_columns(train_rows(spark, sf), ["p1", "p2", "p3", "p4"], LABEL)


@register("q1_auc_per_model", with_fixture(_AUC4_SQL + "SELECT * FROM ma", scores=True))
def q_q1m(spark, sf):
    return model_aucs(spark, sf)


@register("q13_weakest_model", with_fixture(_AUC4_SQL + """
SELECT arg_min(model, auc) AS weakest_model, min(auc) AS min_auc FROM ma""", scores=True))
def q_q13(spark, sf):
    return AN.weakest(model_aucs(spark, sf), "model", "auc")


@register("q14_score_summary", with_fixture("""
SELECT round(min(p1), 6) AS min_score, round(max(p1), 6) AS max_score, round(avg(p1), 6) AS mean_score, count(*) AS n_rows FROM sx""",
                                            scores=True))
def q_q14(spark, sf):
    return round_doubles(ME.score_summary(scored_view(spark, sf), "p1"))


@register("q15_value_counts", with_fixture("""
SELECT stress_level, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS freq
FROM fx WHERE stress_level IS NOT NULL GROUP BY stress_level"""))
def q_q15(spark, sf):
    df = behaviour_view(spark, sf).where(F.col("stress_level").isNotNull())
    return round_doubles(ME.value_frequencies(df, "stress_level"))
