"""Cohort and residual analytics.

All are single aggregates or a group-by with map-side partial aggregation;
none collects rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.columns import rnd
from rankforge.schema import HARD_RESIDUAL


def conditional_means(df: DataFrame, label: str, predicates: dict[str, Column],
                      digits: int | None = 4) -> DataFrame:
    """Q5: ``avg(label) where pred`` for several predicates in ONE aggregate."""
    aggs = []
    for name, pred in predicates.items():
        v = F.avg(F.when(pred, F.col(label).cast("double")))
        aggs.append((rnd(v, digits) if digits is not None else v).alias(name))
    aggs.append(F.count(F.lit(1)).alias("sample_analyzed"))  # Q7
    return df.agg(*aggs)


def group_risk(df: DataFrame, key: str, label: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Q6: per level of ``key`` (NULL keys dropped, as pandas groupby does): count, mean."""
    aggs = [F.count(F.col(label)).alias("count"), F.avg(F.col(label).cast("double")).alias("mean")]
    aggs += [v.alias(k) for k, v in (extra or {}).items()]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def cohort_profile(df: DataFrame, key: str, label: str, feature_cols: list[str]) -> DataFrame:
    """Cohort risk plus mean of each feature per cohort (the flagship query)."""
    extra = {f"avg_{c}": F.avg(c) for c in feature_cols}
    return group_risk(df, key, label, extra)


def absolute_residual(df: DataFrame, label: str, score: str, out: str = "residual") -> DataFrame:
    """Q8: ``abs(y - p)``."""
    return df.withColumn(out, F.abs(F.col(label).cast("double") - F.col(score)))


def hard_samples(df: DataFrame, residual: str = "residual", threshold: float = HARD_RESIDUAL) -> DataFrame:
    """Q9: number and rate of rows with residual above the threshold."""
    hard = F.col(residual) > F.lit(float(threshold))
    return df.agg(F.count_if(hard).alias("n_hard"),
                  F.avg(hard.cast("double")).alias("hard_rate"),
                  F.count(F.lit(1)).alias("n_rows"))


def residual_correlations(df: DataFrame, cols: list[str], residual: str = "residual",
                          medians: dict[str, float] | None = None) -> DataFrame:
    """Q10: Pearson correlation of each (median-filled) numeric column with the residual.

    Exact medians come from the distributed rank primitive (one value per
    column reaches the driver); a single aggregate then computes every
    correlation and ``stack`` turns the one wide row into rows.  Undefined
    correlations (constant column) are dropped.
    """
    if medians is None:
        from rankforge.operators.encode import exact_medians
        medians = {r["col"]: r["median"] for r in exact_medians(df, cols).collect()}
    aggs = []
    for c in cols:
        filled = F.coalesce(F.col(c).cast("double"), F.lit(medians[c]).cast("double"))
        aggs.append(F.corr(filled, F.col(residual)).alias(c))
    wide = df.agg(*aggs)
    args = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.select(F.expr(f"stack({len(cols)}, {args}) AS (feature, corr)"))
    return long.where(F.col("corr").isNotNull() & ~F.isnan("corr"))


def top_abs(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """Sort by |col| descending, keep k (the top-k report is the feature)."""
    return df.orderBy(F.abs(F.col(col)).desc(), F.col(df.columns[0]).asc()).limit(k)


def error_profile(df: DataFrame, label: str, score: str, cols: list[str],
                  threshold: float = 0.5) -> DataFrame:
    """Q11: FP (y=0, p>t) and FN (y=1, p<=t) counts and mean profile of ``cols``."""
    y, p = F.col(label), F.col(score)
    etype = F.when((y == 0) & (p > threshold), F.lit("FP")).when((y == 1) & (p <= threshold), F.lit("FN"))
    return (df.withColumn("error_type", etype).where(F.col("error_type").isNotNull())
              .groupBy("error_type")
              .agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in cols]))


def fold_score_stats(fold_scores: DataFrame, score: str = "auc", by=()) -> DataFrame:
    """Q12: mean and population std of fold scores."""
    return fold_scores.groupBy(*by).agg(F.avg(score).alias("mean_score"),
                                        F.stddev_pop(score).alias("std_score"))


def weakest(scores: DataFrame, name: str = "model", score: str = "auc", by=()) -> DataFrame:
    """Q13: argmin over models (``min_by``)."""
    return scores.groupBy(*by).agg(F.min_by(name, score).alias(f"weakest_{name}"),
                                   F.min(score).alias(f"min_{score}"))
