"""Metrics over score tables (Q1-Q4, Q12-Q15).

AUC and KS read the tie-collapsed value table of ``operators.rank`` — the
data never passes through one task and never joins back to rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.columns import bounded
from rankforge.operators.joins import null_safe_join
from rankforge.operators.rank import prefix_sums, quantile_splits, value_table
from rankforge.schema import LOGLOSS_CLIP
from rankforge.session import cut_lineage, default_buckets


def auc_by(df: DataFrame, score: str, label: str, strata=(), n_buckets: int | None = None) -> DataFrame:
    """Q1/Q2: ROC AUC with ties = 1/2, per stratum (rank-sum / Mann-Whitney form).

    Rows without a score or a label do not count; a stratum with one class only
    has a NULL AUC.
    """
    return auc_of_values(value_table(df.where(F.col(label).isNotNull()), score, strata, label), score, strata, n_buckets)


def auc_of_values(table: DataFrame, score: str, strata=(), n_buckets: int | None = None) -> DataFrame:
    """AUC from a value table: one row per (strata, score) with ``n`` rows, ``npos`` of them positive.

    AUC = sum_v npos_v * (neg_below_v + nneg_v / 2) / (P * Nn).  The numerator is
    kept as ``2 * ...`` in integer-valued doubles so both engines agree exactly.
    The table is stored: its quantiles and its sums each read it.
    """
    strata = list(strata)
    t = cut_lineage(table.withColumn("nneg", F.col("n") - F.col("npos")))
    splits = quantile_splits(t, score, n_buckets or default_buckets(table.sparkSession))
    t = prefix_sums(t, score, strata, ["nneg"], splits)
    num = F.col("npos").cast("double") * (F.lit(2.0) * F.col("before_nneg") + F.col("nneg"))
    agg = t.groupBy(*strata).agg(F.sum(num).alias("_num"), F.sum("npos").alias("n_pos"), F.sum("nneg").alias("n_neg"))
    return agg.select(
        *strata,
        F.try_divide(F.col("_num"), F.lit(2.0) * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")).alias("auc"),
        F.col("n_pos").cast("long").alias("n_pos"),
        F.col("n_neg").cast("long").alias("n_neg"))


def auc_columns(df: DataFrame, scores: list[str], label: str, strata=(),
                n_buckets: int | None = None) -> DataFrame:
    """AUC of several score columns in one plan: stack to (model, value), model is a stratum."""
    strata = list(strata)
    stacked = stack_scores(df, scores, [*strata, label])
    return auc_by(stacked, "value", label, ["model", *strata], n_buckets)


def stack_scores(df: DataFrame, scores: list[str], keep: list[str]) -> DataFrame:
    """Wide score columns -> long (keep..., model, value) via ``stack`` (no join)."""
    args = ", ".join(f"'{s}', CAST(`{s}` AS DOUBLE)" for s in scores)
    return df.select(*keep, F.expr(f"stack({len(scores)}, {args}) AS (model, value)"))


def mean_fold_auc(fold_auc: DataFrame, group=()) -> DataFrame:
    """Q2 tail: mean (and population std) of per-fold AUCs."""
    return fold_auc.groupBy(*group).agg(F.avg("auc").alias("mean_auc"),
                                        F.stddev_pop("auc").alias("std_auc"),
                                        F.count(F.lit(1)).alias("n_folds"))


def row_loss(score: str, label: str, clip: float = LOGLOSS_CLIP) -> Column:
    """Binary cross-entropy of a row, p clipped to [clip, 1-clip]; NULL without a score or a label."""
    p, y = bounded(score, clip, 1.0 - clip), F.col(label).cast("double")
    return -(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))


def log_loss(df: DataFrame, score: str, label: str, strata=(), clip: float = LOGLOSS_CLIP) -> DataFrame:
    """Q3: mean binary cross-entropy with p clipped to [clip, 1-clip]; rows without a score or a label do not count."""
    return df.where(F.col(score).isNotNull()).groupBy(*strata).agg(F.avg(row_loss(score, label, clip)).alias("log_loss"))


def ks_2samp(df: DataFrame, value: str, is_b: str, strata=(), n_buckets: int | None = None) -> DataFrame:
    """Q4: two-sample Kolmogorov-Smirnov statistic D = max |F_A - F_B| per stratum.

    ``is_b`` is a 0/1 (or boolean) column marking sample B.  Evaluated at every
    distinct value of the pooled sample via bucketed prefix sums.  NULL if
    either sample is empty; rows without a value or a mark do not count.
    """
    strata = list(strata)
    b = F.col(is_b).cast("long")
    t = value_table(df.where(F.col(is_b).isNotNull()), value, strata, extra_sums={"n_b": b, "n_a": F.lit(1) - b})
    return ks_of_counts(t, value, strata, n_buckets)


def ks_of_tables(a: DataFrame, b: DataFrame, value: str, strata=(), n_buckets: int | None = None) -> DataFrame:
    """Q4 from value tables (strata, ``value``, n) that were counted before, of either sample: their rows are not read again.
    Tables are mergeable: a sample's table is the union of its parts', summed up here."""
    keep = [*strata, value]
    both = (a.select(*keep, F.col("n").alias("n_a"), F.lit(0).cast("long").alias("n_b"))
            .unionByName(b.select(*keep, F.lit(0).cast("long").alias("n_a"), F.col("n").alias("n_b"))))
    t = both.where(F.col(value).isNotNull()).groupBy(*keep).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    return ks_of_counts(t.withColumn("n", F.col("n_a") + F.col("n_b")), value, strata, n_buckets)


def ks_of_counts(table: DataFrame, value: str, strata=(), n_buckets: int | None = None) -> DataFrame:
    """Q4 from (strata, ``value``, n, n_a, n_b), one row per value."""
    strata = list(strata)
    t = cut_lineage(table)
    splits = quantile_splits(t, value, n_buckets or default_buckets(table.sparkSession),
                             sum_cols=("n_a", "n_b"))
    t = prefix_sums(t, value, strata, ["n_a", "n_b"], splits)
    if strata:
        tot = t.groupBy(*strata).agg(F.sum("n_a").alias("total_a"), F.sum("n_b").alias("total_b"))
        t = null_safe_join(t, tot, strata, broadcast=True)  # one row per stratum
    else:
        t = t.withColumns({"total_a": F.lit(int(splits.sums["n_a"])),
                           "total_b": F.lit(int(splits.sums["n_b"]))})
    cdf_a = F.try_divide(F.col("before_n_a") + F.col("n_a"), F.col("total_a").cast("double"))
    cdf_b = F.try_divide(F.col("before_n_b") + F.col("n_b"), F.col("total_b").cast("double"))
    return t.groupBy(*strata).agg(
        F.max(F.abs(cdf_a - cdf_b)).alias("ks_stat"),
        F.first("total_a").cast("long").alias("n_a"),
        F.first("total_b").cast("long").alias("n_b"))


def drift_gate(ks: DataFrame, threshold: float) -> DataFrame:
    """Pass iff the statistic is at most the threshold (p-value ignored)."""
    return ks.withColumn("passed", F.col("ks_stat") <= F.lit(float(threshold)))


def score_summary(df: DataFrame, score: str) -> DataFrame:
    """Q14: min / max / mean / row count of a score column."""
    return df.agg(F.min(score).alias("min_score"), F.max(score).alias("max_score"),
                  F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("n_rows"))


def value_frequencies(df: DataFrame, col: str, by=()) -> DataFrame:
    """Q15: normalised value counts (per group ``by`` if given)."""
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    tot = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"))
    j = null_safe_join(counts, tot, list(by)) if by else \
        counts.withColumn("_total", F.lit(df.count()))
    return j.select(*by, col, "n", (F.col("n") / F.col("_total")).alias("freq"))
