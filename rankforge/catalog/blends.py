"""Blend queries (X1-X7) and level-2 meta features."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankforge.catalog import sqlparts as SP
from rankforge.catalog.base import register
from rankforge.catalog.splits_metrics import K, SEED, train_folds, train_rows
from rankforge.functions.columns import rnd, round_doubles
from rankforge.functions.normal import sql_double
from rankforge.operators import blend as BL
from rankforge.operators import rank as RK
from rankforge.schema import LABEL
from rankforge.session import cut_lineage
from rankforge.sources.fixture import scored_view, with_fixture

SCORES = ["p1", "p2", "p3", "p4"]
RANKS = [f"r_{p}" for p in SCORES]
_TR = ", tr AS (SELECT * FROM sx WHERE split = 'train')"
_RK = (", rk AS (SELECT id, " + LABEL + ", "
       + ", ".join(f"{SP.pct_rank(p)} AS r_{p}" for p in SCORES) + " FROM tr)")


def ranked_train(spark, sf, extra=()):
    """Train rows with percentile ranks r_p1..r_p4 (W2, distributed)."""
    df = train_rows(spark, sf).select("id", LABEL, *extra, *SCORES)
    return RK.percentile_rank_columns(df, SCORES, prefix="r_")


def _wsum_sql(ws, cols) -> str:
    return " + ".join(f"{sql_double(w)} * {c}" for w, c in zip(ws, cols))


def _cand_values(cands, alphas=None) -> str:
    rows = []
    i = 0
    for w in cands:
        for a in (alphas if alphas is not None else [None]):
            vals = [str(i)] + [sql_double(x) for x in w] + ([sql_double(a)] if a is not None else [])
            rows.append("(" + ", ".join(vals) + ")")
            i += 1
    m = len(cands[0])
    names = ["cand"] + [f"w{j + 1}" for j in range(m)] + (["alpha"] if alphas is not None else [])
    return f"cand AS (SELECT * FROM (VALUES {', '.join(rows)}) t({', '.join(names)}))"


def lattice_sql(cands, cols, alphas=None, other=None, loss_weight=0.0, strata="", top=10) -> str:
    """The best candidates by the exact AUC of every candidate."""
    m = len(cols)
    wsum = " + ".join(f"w{j + 1} * {c}" for j, c in enumerate(cols))
    score = f"({wsum})" if alphas is None else f"(alpha * ({wsum}) + (1.0e0 - alpha) * {other})"
    sp = f"{strata}, " if strata else ""
    p = "least(greatest(score, 1e-7), 1.0e0 - 1e-7)"
    loss = f"-(CAST(y AS DOUBLE) * ln({p}) + (1.0e0 - CAST(y AS DOUBLE)) * ln(1.0e0 - {p}))" if loss_weight else "0.0e0"
    wcols = ", ".join(f"w{j + 1}" for j in range(m)) + (", alpha" if alphas is not None else "")
    goal = f"round(auc - {sql_double(loss_weight)} * log_loss, 9)" if loss_weight else "auc"
    more = f", round(log_loss, 6) AS log_loss, round({sql_double(loss_weight)} * log_loss - auc, 6) AS objective" if loss_weight else ""
    part = f"PARTITION BY {strata} " if strata else ""
    return f"""
, {_cand_values(cands, alphas)},
  sc AS (SELECT {sp}c.cand, {LABEL} AS y, {score} AS score FROM rk CROSS JOIN cand c),
  g AS (SELECT {sp}cand, score, sum(y) AS npos, sum(1 - y) AS nneg, count(*) AS n, sum({loss}) AS loss
        FROM sc GROUP BY {sp}cand, score),
  c2 AS (SELECT *, coalesce(sum(nneg) OVER (PARTITION BY {sp}cand ORDER BY score
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_neg FROM g),
  res AS (SELECT {sp}cand, sum(npos * (2.0e0 * before_neg + nneg)) / (2.0e0 * sum(npos) * sum(nneg)) AS auc,
            sum(loss) / sum(n) AS log_loss FROM c2 GROUP BY {sp}cand),
  rkd AS (SELECT *, CAST(row_number() OVER ({part}ORDER BY {goal} DESC, cand) AS INTEGER) AS rank FROM res),
  out AS (SELECT {sp}rank, cand, {wcols}, auc{more} FROM rkd JOIN cand USING (cand) WHERE rank <= {top})
"""


# ---------------------------------------------------------------------------------
# Fixed blends
# ---------------------------------------------------------------------------------
@register("x1_uniform_blend", with_fixture("SELECT id, (p1 + p2 + p3 + p4) / 4.0e0 AS score FROM sx", scores=True))
def q_x1(spark, sf):
    return scored_view(spark, sf).select("id", BL.uniform_blend(SCORES).alias("score"))


X2_W = (0.4, 0.3, 0.2, 0.1)


@register("x2_weighted_rank_blend", with_fixture(_TR + _RK + f"\nSELECT id, {_wsum_sql(X2_W, RANKS)} AS score FROM rk",
                                                 scores=True))
def q_x2(spark, sf):
    return ranked_train(spark, sf).select("id", BL.weighted_blend(RANKS, X2_W).alias("score"))


@register("x7_rank_mean_fallback", with_fixture(_TR + _RK + "\nSELECT id, (" + " + ".join(RANKS)
                                                + ") / 4.0e0 AS score FROM rk", scores=True))
def q_x7(spark, sf):
    return ranked_train(spark, sf).select("id", BL.uniform_blend(RANKS).alias("score"))


# ---------------------------------------------------------------------------------
# Simplex lattice search, the best ten by exact AUC (a top-k report)
# ---------------------------------------------------------------------------------
X3_CANDS = BL.simplex_lattice(4, 10)
X5_CANDS = BL.simplex_lattice(3, 20)


@register("x3_simplex_lattice_auc", with_fixture(_TR + _RK + lattice_sql(X3_CANDS, RANKS) + "SELECT * FROM out",
                                                 scores=True))
def q_x3(spark, sf):
    return BL.lattice_search(ranked_train(spark, sf), RANKS, LABEL, X3_CANDS)


@register("x5_convex_blend_lattice", with_fixture(_TR + _RK + lattice_sql(X5_CANDS, RANKS[:3])
                                                  + "SELECT * FROM out", scores=True))
def q_x5(spark, sf):
    return BL.lattice_search(ranked_train(spark, sf), RANKS[:3], LABEL, X5_CANDS)


def _fit_rows(spark, fit, cols, other=None):
    rows = [(c, float(w)) for c, w in zip(cols, fit.weights)] + ([(other, float(fit.alpha))] if other else [])
    return spark.createDataFrame([(c, w, float(fit.auc), fit.chosen) for c, w in rows],
                                 "model string, weight double, auc double, chosen string")


def _stored_ranks(spark, sf):
    return cut_lineage(ranked_train(spark, sf).select(LABEL, *RANKS))


@register("x3_refined_blend_fit")
def q_x3_fit(spark, sf):
    """Refined lattice search + exact winner check (ROWS: data-dependent lattice)."""
    return _fit_rows(spark, BL.fit_blend(_stored_ranks(spark, sf), RANKS, LABEL), RANKS)


@register("x4_refined_blend_fit")
def q_x4_fit(spark, sf):
    """Tree weights and alpha by AUC and log loss (the weight shown for the second stage is alpha)."""
    fit = BL.fit_blend(_stored_ranks(spark, sf), RANKS[:3], LABEL, RANKS[3], divisions=5, loss_weight=1e-4)
    return _fit_rows(spark, fit, RANKS[:3], RANKS[3])


@register("x6_refined_blend_fit")
def q_x6_fit(spark, sf):
    """Tree weights and alpha by AUC alone."""
    return _fit_rows(spark, BL.fit_blend(_stored_ranks(spark, sf), RANKS[:3], LABEL, RANKS[3], divisions=5), RANKS[:3], RANKS[3])


# ---------------------------------------------------------------------------------
# Two-stage blend lattice (tree weights x alpha)
# ---------------------------------------------------------------------------------
X4_CANDS = BL.simplex_lattice(3, 5)
X4_ALPHAS = [i / 10 for i in range(11)]


@register("x4_two_stage_lattice", with_fixture(
    _TR + _RK + lattice_sql(X4_CANDS, RANKS[:3], X4_ALPHAS, RANKS[3], 1e-4) + "SELECT * FROM out", scores=True))
def q_x4(spark, sf):
    res = BL.lattice_search(ranked_train(spark, sf), RANKS[:3], LABEL, X4_CANDS, other=RANKS[3],
                            alphas=X4_ALPHAS, loss_weight=1e-4)
    return res.withColumns({"log_loss": rnd("log_loss"), "objective": rnd("objective")})


@register("x6_two_stage_auc_lattice", with_fixture(
    _TR + _RK + lattice_sql(X4_CANDS, RANKS[:3], X4_ALPHAS, RANKS[3]) + "SELECT * FROM out", scores=True))
def q_x6(spark, sf):
    return BL.lattice_search(ranked_train(spark, sf), RANKS[:3], LABEL, X4_CANDS, other=RANKS[3], alphas=X4_ALPHAS)


# ---------------------------------------------------------------------------------
# Meta features;  G21: logit tree blend then rank blend;  G22: weight averaging
# ---------------------------------------------------------------------------------
def _logit_sql(p, clip="1e-6"):
    q = f"least(greatest({p}, {clip}), 1.0e0 - {clip})"
    return f"ln({q} / (1.0e0 - {q}))"


def _g20_sql():
    z = {p: _logit_sql(p) for p in SCORES}
    cols = [f"round({z[p]}, 6) AS logit_{p}" for p in SCORES]
    for i, a in enumerate(SCORES):
        for b in SCORES[i + 1:]:
            cols.append(f"round({z[a]} - {z[b]}, 6) AS dlogit_{a}_{b}")
    mean = "(" + " + ".join(z[p] for p in SCORES) + ") / 4.0e0"
    cols.append(f"round({mean}, 6) AS logit_mean")
    var = "(" + " + ".join(f"({z[p]} - {mean}) * ({z[p]} - {mean})" for p in SCORES) + ") / 4.0e0"
    cols.append(f"round({var}, 6) AS logit_var")
    cols.append(f"round(greatest({', '.join(z.values())}) - least({', '.join(z.values())}), 6) AS logit_spread")
    return "SELECT id, " + ", ".join(cols) + " FROM sx"


@register("g20_meta_features", with_fixture(_g20_sql(), scores=True))
def q_g20(spark, sf):
    df = scored_view(spark, sf)
    return round_doubles(df.select("id", *[v.alias(k) for k, v in BL.meta_features(SCORES).items()]))


G21_W = (1 / 3, 1 / 3, 1 / 3)
G21_ALPHA = 0.8


def _g21_sql():
    z = " + ".join(f"{sql_double(w)} * {_logit_sql(p, '1e-5')}" for w, p in zip(G21_W, SCORES[:3]))
    tree = f"(1.0e0 / (1.0e0 + exp(-({z}))))"
    return f"""
, t AS (SELECT id, p4, round({tree}, 12) AS tree FROM sx),
  r AS (SELECT id, {SP.pct_rank('tree')} AS r_tree, {SP.pct_rank('p4')} AS r_p4 FROM t)
SELECT id, round({sql_double(G21_ALPHA)} * r_tree + {sql_double(1.0 - G21_ALPHA)} * r_p4, 6) AS score FROM r"""


@register("g21_logit_then_rank_blend", with_fixture(_g21_sql(), scores=True))
def q_g21(spark, sf):
    df = scored_view(spark, sf).select("id", *SCORES)
    out = BL.logit_then_rank_blend(df, SCORES[:3], G21_W, "p4", G21_ALPHA, tie_digits=12)
    return out.select("id", rnd("score").alias("score"))


G22_CANDS = BL.simplex_lattice(4, 5)
_G22_SQL = (", " + SP.folds_cte(K, SEED) + ", rk AS (SELECT id, fold, " + LABEL + ", "
            + ", ".join(f"{SP.pct_rank(p)} AS r_{p}" for p in SCORES) + " FROM fo)"
            + lattice_sql(G22_CANDS, RANKS, strata="fold", top=1) + """
, win AS (SELECT * FROM out),
  lng AS (SELECT CASE wn WHEN 'w1' THEN 'r_p1' WHEN 'w2' THEN 'r_p2' WHEN 'w3' THEN 'r_p3' ELSE 'r_p4' END AS model,
                 weight FROM (UNPIVOT (SELECT w1, w2, w3, w4 FROM win) ON w1, w2, w3, w4 INTO NAME wn VALUE weight))
SELECT model, round(avg(weight), 6) AS avg_weight, count(*) AS n_runs FROM lng GROUP BY model""")


@register("g22_seed_weight_average", with_fixture(_TR + _G22_SQL, scores=True))
def q_g22(spark, sf):
    fo = train_folds(spark, sf).select("id", "fold", LABEL, *SCORES)
    ranked = RK.percentile_rank_columns(fo, SCORES, prefix="r_")
    winners = BL.per_stratum_winners(ranked, RANKS, LABEL, ["fold"], divisions=5)
    return round_doubles(BL.average_weights(winners, RANKS))
