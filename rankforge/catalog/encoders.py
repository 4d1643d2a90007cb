"""Imputation and encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.catalog import sqlparts as SP
from rankforge.catalog.base import D, register
from rankforge.catalog.splits_metrics import K, SEED, train_folds, train_rows
from rankforge.functions.columns import round_doubles
from rankforge.operators import encode as EN
from rankforge.operators import rank as RK
from rankforge.schema import CATEGORICAL_COLUMNS, LABEL, NUMERIC_COLUMNS, TE_SMOOTHING
from rankforge.session import stored
from rankforge.sources.fixture import behaviour_view, scored_view, with_fixture

LEVEL_COLS = ["gender", "stress_level", "academic_work_impact", "gender_stress_level",
              "gender_academic_work_impact", "stress_level_academic_work_impact"]
CATS = CATEGORICAL_COLUMNS
M = f"{TE_SMOOTHING!r}e0" if "e" not in repr(TE_SMOOTHING) else repr(TE_SMOOTHING)


def _lv(c: str) -> str:
    return f"coalesce({c}, '__missing__')"


LEVELS_SQL = (f"{_lv('gender')} AS gender, {_lv('stress_level')} AS stress_level, "
              f"{_lv('academic_work_impact')} AS academic_work_impact, "
              f"{_lv('gender')} || '_' || {_lv('stress_level')} AS gender_stress_level, "
              f"{_lv('gender')} || '_' || {_lv('academic_work_impact')} AS gender_academic_work_impact, "
              f"{_lv('stress_level')} || '_' || {_lv('academic_work_impact')} AS stress_level_academic_work_impact")
_TR = ", tr AS (SELECT * FROM sx WHERE split = 'train')"
_FO = f", {SP.folds_cte(K, SEED)}"
_UNP = ", ".join(LEVEL_COLS)


def levels(df):
    return df.withColumns(EN.discrete_levels(df))


# ---------------------------------------------------------------------------------
# E5: discrete levels
# ---------------------------------------------------------------------------------
@register("e5_discrete_levels", with_fixture(f"SELECT id, {LEVELS_SQL} FROM fx"))
def q_e5(spark, sf):
    return levels(behaviour_view(spark, sf)).select("id", *LEVEL_COLS)


# ---------------------------------------------------------------------------------
# Global smoothed target encoding / frequency encoding
# ---------------------------------------------------------------------------------
_E6_BASE = _TR + f"""
, lvt AS (SELECT {LABEL}, {LEVELS_SQL} FROM tr),
  ln AS (SELECT {LABEL}, col, level FROM (UNPIVOT lvt ON {_UNP} INTO NAME col VALUE level)),
  a AS (SELECT col, level, count(*) AS n, sum({LABEL}) AS s FROM ln GROUP BY col, level),
  t AS (SELECT col, sum(n) AS tot_n, sum(s) AS tot_s FROM a GROUP BY col),
  gm AS (SELECT col, level, n, (s + {M} * (tot_s / CAST(tot_n AS DOUBLE))) / (n + {M}) AS te,
           n / CAST(tot_n AS DOUBLE) AS freq, tot_s / CAST(tot_n AS DOUBLE) AS global_mean FROM a JOIN t USING (col))
"""


def global_map(spark, sf):
    tr = levels(train_rows(spark, sf))
    return EN.target_encoding_map(tr, LEVEL_COLS, LABEL)


@register("e6_target_encoding", with_fixture(_E6_BASE + "SELECT col, level, n, round(te, 6) AS te FROM gm",
                                             scores=True))
def q_e6(spark, sf):
    return round_doubles(global_map(spark, sf).select("col", "level", "n", "te"))


@register("e7_frequency_encoding", with_fixture(_E6_BASE + "SELECT col, level, round(freq, 6) AS freq FROM gm",
                                                scores=True))
def q_e7(spark, sf):
    return round_doubles(global_map(spark, sf).select("col", "level", "freq"))


# ---------------------------------------------------------------------------------
# Out-of-fold encoding (one pass) and its row application; J4 fold loop
# ---------------------------------------------------------------------------------
_E8_BASE = _TR + _FO + f"""
, lvf AS (SELECT id, fold, {LABEL}, {LEVELS_SQL} FROM fo),
  ln AS (SELECT fold, {LABEL}, col, level FROM (UNPIVOT lvf ON {_UNP} INTO NAME col VALUE level)),
  a AS (SELECT col, level, fold, count(*) AS n, sum({LABEL}) AS s FROM ln GROUP BY col, level, fold),
  a2 AS (SELECT *, sum(n) OVER (PARTITION BY col, level) AS tn, sum(s) OVER (PARTITION BY col, level) AS ts FROM a),
  pf AS (SELECT col, fold, sum(n) AS fn, sum(s) AS fs FROM a GROUP BY col, fold),
  pc AS (SELECT col, sum(n) AS an, sum(s) AS as_ FROM a GROUP BY col),
  m AS (SELECT col, level, fold, n,
          CASE WHEN tn - n > 0 THEN ((ts - s) + {M} * ((as_ - fs) / CAST(an - fn AS DOUBLE))) / ((tn - n) + {M})
               ELSE (as_ - fs) / CAST(an - fn AS DOUBLE) END AS te,
          (tn - n) / CAST(an - fn AS DOUBLE) AS freq
        FROM a2 JOIN pf USING (col, fold) JOIN pc USING (col))
"""


def oof_map(spark, sf):
    return EN.oof_encoding_map(levels(train_folds(spark, sf)), LEVEL_COLS, LABEL, "fold")


@register("e8_oof_target_encoding", with_fixture(
    _E8_BASE + "SELECT col, level, fold, n, round(te, 6) AS te FROM m", scores=True))
def q_e8(spark, sf):
    return round_doubles(oof_map(spark, sf).select("col", "level", "fold", "n", "te"))


@register("e9_oof_frequency_encoding", with_fixture(
    _E8_BASE + "SELECT col, level, fold, round(freq, 6) AS freq FROM m", scores=True))
def q_e9(spark, sf):
    return round_doubles(oof_map(spark, sf).select("col", "level", "fold", "freq"))


_ROW_COLS = LEVEL_COLS
_E9_ROWS_SQL = _E8_BASE + "SELECT r.id, r.fold, " + ", ".join(
    f"round(m{i}.te, 6) AS {c}_te, round(m{i}.freq, 6) AS {c}_freq" for i, c in enumerate(_ROW_COLS)) + " FROM lvf r " + " ".join(
    f"LEFT JOIN m m{i} ON m{i}.col = '{c}' AND m{i}.level = r.{c} AND m{i}.fold = r.fold" for i, c in enumerate(_ROW_COLS))


@register("e8_oof_encoded_rows", with_fixture(_E9_ROWS_SQL, scores=True))
def q_e8_rows(spark, sf):
    fo = train_folds(spark, sf)
    lv = EN.discrete_levels(fo)
    enc = EN.oof_encoding_map(fo.withColumns(lv), LEVEL_COLS, LABEL, "fold")
    out = EN.apply_oof_encoding(fo.select("id", "fold", *CATS), enc, {c: lv[c] for c in _ROW_COLS}, "fold")
    return round_doubles(out.select("id", "fold", *[f"{c}_{s}" for c in _ROW_COLS for s in ("te", "freq")]))


@register("j4_fold_loop_union", with_fixture(_E9_ROWS_SQL, scores=True))
def q_j4(spark, sf):
    """Fold-by-fold frozen encoders, scattered back with unionByName (cross-checks E8)."""
    fo = stored(train_folds(spark, sf).select("id", "fold", LABEL, *CATS), "folds")
    lv = EN.discrete_levels(fo)
    parts = []
    for k in range(K):
        fit = fo.where(F.col("fold") != k)
        enc = EN.target_encoding_map(fit.withColumns(lv), LEVEL_COLS, LABEL)
        val = fo.where(F.col("fold") == k)
        parts.append(EN.apply_frozen_encoding(val.select("id", "fold", *CATS), enc,
                                              {c: lv[c] for c in _ROW_COLS}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return round_doubles(out.select("id", "fold", *[f"{c}_{s}" for c in _ROW_COLS for s in ("te", "freq")]))


# ---------------------------------------------------------------------------------
# Frozen map applied to new rows
# ---------------------------------------------------------------------------------
_E10_COLS = ", ".join(f"round(coalesce(m{i}.te, (SELECT global_mean FROM means WHERE col = '{c}')), 6) AS {c}_te, "
                      f"round(coalesce(m{i}.freq, 0.0e0), 6) AS {c}_freq" for i, c in enumerate(LEVEL_COLS))
_E10_JOINS = " ".join(f"LEFT JOIN gm m{i} ON m{i}.col = '{c}' AND m{i}.level = r.{c}" for i, c in enumerate(LEVEL_COLS))


@register("e10_frozen_encoding", with_fixture(_E6_BASE + f"""
, te_rows AS (SELECT id, {LEVELS_SQL} FROM sx WHERE split = 'test'),
  means AS (SELECT DISTINCT col, global_mean FROM gm)
SELECT r.id, {_E10_COLS} FROM te_rows r {_E10_JOINS}""", scores=True))
def q_e10(spark, sf):
    test = scored_view(spark, sf).where(F.col("split") == "test").select("id", *CATS)
    out = EN.apply_frozen_encoding(test, global_map(spark, sf), EN.discrete_levels(test))
    return round_doubles(out.select("id", *[f"{c}_{s}" for c in LEVEL_COLS for s in ("te", "freq")]))


# ---------------------------------------------------------------------------------
# E1 median impute, E2 mode impute
# ---------------------------------------------------------------------------------
@register("e1_median_impute", with_fixture(_TR + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, median({c}) AS median FROM tr" for c in NUMERIC_COLUMNS), scores=True))
def q_e1(spark, sf):
    return EN.exact_medians(train_rows(spark, sf), NUMERIC_COLUMNS)


def _mode_sql(c: str, src: str) -> str:
    return (f"coalesce((SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1), 'Unknown')")


@register("e2_mode_impute", with_fixture(_TR + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, {_mode_sql(c, 'tr')} AS mode" for c in CATS), scores=True))
def q_e2(spark, sf):
    return EN.modes(train_rows(spark, sf), CATS)


# ---------------------------------------------------------------------------------
# E3 label codes (+ J3 unseen), E4 ordinal codes, E12 category index
# ---------------------------------------------------------------------------------
_FIT = ", fit AS (SELECT * FROM fx WHERE gender = 'Male' OR gender IS NULL)"


def _fit_rows(spark, sf):
    df = behaviour_view(spark, sf)
    return df.where((F.col("gender") == "Male") | F.col("gender").isNull()), df


def _miss(src: str) -> str:
    return (f"SELECT DISTINCT col, level FROM (UNPIVOT (SELECT coalesce(gender, 'Missing') AS gender, "
            f"coalesce(stress_level, 'Missing') AS stress_level, "
            f"coalesce(academic_work_impact, 'Missing') AS academic_work_impact FROM {src}) "
            f"ON gender, stress_level, academic_work_impact INTO NAME col VALUE level)")


_E3_BASE = _FIT + f"""
, trl AS ({_miss('fit')}),
  apl AS ({_miss('fx')}),
  unseen AS (SELECT a.col, a.level FROM apl a WHERE NOT EXISTS
             (SELECT 1 FROM trl t WHERE t.col = a.col AND t.level = a.level))
"""


@register("e3_label_encoding", with_fixture(_E3_BASE + """
, ncls AS (SELECT col, count(*) AS n FROM trl GROUP BY col)
SELECT col, level, CAST(row_number() OVER (PARTITION BY col ORDER BY level) - 1 AS INTEGER) AS code, true AS seen
FROM trl
UNION ALL
SELECT u.col, u.level, CAST(coalesce(n.n, 0) + row_number() OVER (PARTITION BY u.col ORDER BY u.level) - 1 AS INTEGER),
       false FROM unseen u LEFT JOIN ncls n USING (col)"""))
def q_e3(spark, sf):
    fit, full = _fit_rows(spark, sf)
    return EN.label_code_map(fit, full, CATS).select("col", "level", "code", "seen")


@register("j3_unseen_classes", with_fixture(_E3_BASE + "SELECT col, level FROM unseen"))
def q_j3(spark, sf):
    fit, full = _fit_rows(spark, sf)
    return EN.unseen_levels(fit, full, CATS)


def _codes_sql(src):
    return (f"SELECT col, level, row_number() OVER (PARTITION BY col ORDER BY level) - 1 AS code FROM "
            f"(SELECT DISTINCT col, level FROM (UNPIVOT {src} ON gender, stress_level, academic_work_impact "
            f"INTO NAME col VALUE level))")


@register("e4_ordinal_encoding", with_fixture(_FIT + f"""
, md AS (SELECT {_mode_sql('gender', 'fit')} AS mg, {_mode_sql('stress_level', 'fit')} AS ms,
                {_mode_sql('academic_work_impact', 'fit')} AS mi),
  fitf AS (SELECT coalesce(gender, mg) AS gender, coalesce(stress_level, ms) AS stress_level,
                  coalesce(academic_work_impact, mi) AS academic_work_impact FROM fit, md),
  codes AS ({_codes_sql('fitf')}),
  allf AS (SELECT id, coalesce(gender, mg) AS gender, coalesce(stress_level, ms) AS stress_level,
                  coalesce(academic_work_impact, mi) AS academic_work_impact FROM fx, md)
SELECT a.id, CAST(coalesce(c1.code, -1) AS INTEGER) AS gender, CAST(coalesce(c2.code, -1) AS INTEGER) AS stress_level,
       CAST(coalesce(c3.code, -1) AS INTEGER) AS academic_work_impact
FROM allf a
LEFT JOIN codes c1 ON c1.col = 'gender' AND c1.level = a.gender
LEFT JOIN codes c2 ON c2.col = 'stress_level' AND c2.level = a.stress_level
LEFT JOIN codes c3 ON c3.col = 'academic_work_impact' AND c3.level = a.academic_work_impact"""))
def q_e4(spark, sf):
    fit, full = _fit_rows(spark, sf)
    fit_f, full_f = EN.mode_impute(fit, [fit, full], CATS)
    codes = EN.ordinal_code_map(fit_f, CATS)
    return EN.apply_codes(full_f.select("id", *CATS), codes, CATS, token=None, unknown=-1)


@register("e12_category_index", with_fixture(_FIT + """
, lv AS (SELECT col, level, CAST(row_number() OVER (PARTITION BY col ORDER BY level) - 1 AS DOUBLE) AS idx
         FROM (SELECT DISTINCT col, level FROM (UNPIVOT (SELECT gender, stress_level, academic_work_impact FROM fit)
               ON gender, stress_level, academic_work_impact INTO NAME col VALUE level) WHERE level IS NOT NULL)),
  nl AS (SELECT col, CAST(count(*) AS DOUBLE) AS n FROM lv GROUP BY col)
SELECT f.id,
  coalesce(l1.idx, (SELECT n FROM nl WHERE col = 'gender')) AS gender_idx,
  coalesce(l2.idx, (SELECT n FROM nl WHERE col = 'stress_level')) AS stress_level_idx,
  coalesce(l3.idx, (SELECT n FROM nl WHERE col = 'academic_work_impact')) AS academic_work_impact_idx
FROM fx f
LEFT JOIN lv l1 ON l1.col = 'gender' AND l1.level = f.gender
LEFT JOIN lv l2 ON l2.col = 'stress_level' AND l2.level = f.stress_level
LEFT JOIN lv l3 ON l3.col = 'academic_work_impact' AND l3.level = f.academic_work_impact"""))
def q_e12(spark, sf):
    fit, full = _fit_rows(spark, sf)
    return EN.category_index(fit, full.select("id", *CATS), CATS).select(
        "id", *[f"{c}_idx" for c in CATS])


# ---------------------------------------------------------------------------------
# Zero-fill + standardise (population std)
# ---------------------------------------------------------------------------------
_STD_COLS = SP.RAW_NUMERIC


@register("e11_standardize", with_fixture(_TR + """
, st AS (SELECT """ + ", ".join(
    f"avg(coalesce({c}, 0.0e0)) AS m_{i}, stddev_pop(coalesce({c}, 0.0e0)) AS s_{i}"
    for i, c in enumerate(_STD_COLS)) + """ FROM tr)
SELECT id, """ + ", ".join(
    f"round((coalesce({c}, 0.0e0) - m_{i}) / (CASE WHEN s_{i} IS NULL OR s_{i} = 0 THEN 1.0e0 ELSE s_{i} END), 6) AS {c}"
    for i, c in enumerate(_STD_COLS)) + """
FROM sx, st WHERE split = 'test'""", scores=True))
def q_e11(spark, sf):
    view = scored_view(spark, sf)
    tr = view.where(F.col("split") == "train")
    te = view.where(F.col("split") == "test").select("id", *_STD_COLS)
    (out,) = EN.standardize(tr, [te], _STD_COLS)
    return round_doubles(out)


# ---------------------------------------------------------------------------------
# G5 joint profile frequency (+ J1 lookup with fill), G14 value frequency, G15 cohort residual
# ---------------------------------------------------------------------------------
_JOINT = ("concat_ws('_', coalesce(gender, 'nan'), coalesce(stress_level, 'nan'), "
          "coalesce(academic_work_impact, 'nan'))")
_G5_BASE = _TR + f"""
, jm AS (SELECT {_JOINT} AS k, count(*) AS n, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS freq
         FROM tr GROUP BY 1)
"""


def _joint_map(spark, sf):
    view = scored_view(spark, sf)
    fmap, total = EN.frequency_map(view.where(F.col("split") == "train"), EN.joint_profile_key())
    return view, fmap, total


@register("g5_joint_profile_freq", with_fixture(_G5_BASE + f"""
SELECT s.id, round(jm.freq, 6) AS joint_profile_freq FROM sx s LEFT JOIN jm ON jm.k = {_JOINT.replace('(gender', '(s.gender')}""",
                                                scores=True))
def q_g5(spark, sf):
    view, fmap, total = _joint_map(spark, sf)
    out = EN.apply_frequency(view.select("id", *CATS), fmap, EN.joint_profile_key(), "joint_profile_freq")
    return round_doubles(out.select("id", "joint_profile_freq"))


@register("j1_dictionary_lookup", with_fixture(_G5_BASE + f"""
SELECT s.id, round(coalesce(jm.freq, 0.0e0), 6) AS joint_profile_freq
FROM (SELECT * FROM sx WHERE split = 'test') s LEFT JOIN jm ON jm.k = {_JOINT.replace('(gender', '(s.gender')}""",
                                                 scores=True))
def q_j1(spark, sf):
    view, fmap, total = _joint_map(spark, sf)
    test = view.where(F.col("split") == "test").select("id", *CATS)
    out = EN.apply_frequency(test, fmap, EN.joint_profile_key(), "joint_profile_freq")
    return round_doubles(out.select("id", F.coalesce("joint_profile_freq", F.lit(0.0)).alias("joint_profile_freq")))


_G14_MAPS = ", ".join(f"v{i} AS (SELECT {c} AS v, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS freq FROM tr WHERE {c} IS NOT NULL GROUP BY 1)"
                      for i, c in enumerate(SP.RAW_NUMERIC))
_G14_JOINS = " ".join(f"LEFT JOIN v{i} ON v{i}.v = s.{c}" for i, c in enumerate(SP.RAW_NUMERIC))


@register("g14_value_frequency", with_fixture(_TR + f"""
, {_G14_MAPS}
SELECT s.id, {", ".join(f"round(v{i}.freq, 6) AS {c}_freq" for i, c in enumerate(SP.RAW_NUMERIC))}
FROM (SELECT * FROM sx WHERE split = 'test') s {_G14_JOINS}""", scores=True))
def q_g14(spark, sf):
    view = scored_view(spark, sf)
    maps = EN.frequency_maps(view.where(F.col("split") == "train"), SP.RAW_NUMERIC)
    out = EN.apply_frequencies(view.where(F.col("split") == "test").select("id", *SP.RAW_NUMERIC), maps, SP.RAW_NUMERIC)
    return round_doubles(out.select("id", *[f"{c}_freq" for c in SP.RAW_NUMERIC]))


@register("g15_cohort_residual", with_fixture(f"""
SELECT id, round({SP.SCR} - avg({SP.SCR}) OVER (PARTITION BY age, gender), 6) AS {SP.SCR}_cohort_resid FROM fx"""))
def q_g15(spark, sf):
    df = behaviour_view(spark, sf).select("id", "age", "gender", SP.SCR)
    return round_doubles(EN.cohort_residual(df, SP.SCR, ["age", "gender"]).select("id", f"{SP.SCR}_cohort_resid"))


# ---------------------------------------------------------------------------------
# Positional stacking of per-model predictions -> 1:1 join on id
# ---------------------------------------------------------------------------------
@register("j2_prediction_stacking", with_fixture(f"""
SELECT id, {SP.pct_rank('p1')} AS r_p1, {SP.pct_rank('p2')} AS r_p2 FROM sx""", scores=True))
def q_j2(spark, sf):
    """The models' ranks side by side on the same row: no join by position or key."""
    view = scored_view(spark, sf).select("id", "p1", "p2")
    return RK.percentile_rank_columns(view, ["p1", "p2"]).select("id", "r_p1", "r_p2")
