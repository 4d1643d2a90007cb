"""Deterministic, hash-based sampling and splitting.

Row order is not a Spark concept, so every split is a function of the row key:
``h = md5(seed ':' key)``.  Ranking rows by ``(h, key)`` inside a stratum
needs no quantile pass — the leading hex digits of ``h`` are uniform range
buckets.  Per-bucket counts (|strata| x 16^d rows) give running offsets that
are broadcast back; inside a bucket a ``row_number`` window finishes the rank.
No task ever sees more than ~N / (|strata| x 16^d) rows and the md5 prefix
cannot be skewed.  A NULL stratum is a stratum of its own: no row is lost.  A
NULL key hashes to NULL and ranks first in its stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.joins import null_safe_join

_H, _HB, _RANK = "_h", "_hb", "_rank"


def _hash(key: str, seed) -> Column:
    seed_col = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(seed_col.cast("string"), F.lit(":"), F.col(key).cast("string")))


def hash_rank(df: DataFrame, strata: list[str], key: str = "id", seed=42,
              hex_digits: int = 4, out: str = _RANK) -> DataFrame:
    """Adds ``out`` = 1-based rank of the row by (md5(seed:key), key) within its stratum."""
    d = (df.withColumn(_H, _hash(key, seed))
           .withColumn(_HB, F.conv(F.substring(F.col(_H), 1, hex_digits), 16, 10).cast("int")))
    counts = d.groupBy(*strata, _HB).agg(F.count(F.lit(1)).alias("_cnt"))
    w_off = Window.partitionBy(*strata).orderBy(_HB).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*strata, _HB, F.coalesce(F.sum("_cnt").over(w_off), F.lit(0)).alias("_off"))
    # |strata| x 16^hex_digits rows: bounded by construction
    w_in = Window.partitionBy(*strata, _HB).orderBy(_H, key)
    return (null_safe_join(d, offsets, [*strata, _HB], broadcast=True)
             .withColumn(out, F.col("_off") + F.row_number().over(w_in))
             .drop(_H, _HB, "_off"))


def stratified_folds(df: DataFrame, k: int, label: str, key: str = "id", seed=42,
                     out: str = "fold", hex_digits: int = 4) -> DataFrame:
    """Stratified, shuffled, seeded k-fold; per-class fold sizes differ by <= 1."""
    return (hash_rank(df, [label], key, seed, hex_digits)
            .withColumn(out, ((F.col(_RANK) - 1) % k).cast("int")).drop(_RANK))


def fold_split(df: DataFrame, k: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(train = all but fold k, validation = fold k)."""
    return df.where(F.col(fold_col) != k), df.where(F.col(fold_col) == k)


def nested_folds(df: DataFrame, k_outer: int, k_inner: int, label: str, key: str = "id",
                 seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Encoder folds inside each training part, seed = base + outer fold.

    Each row belongs to the k-1 training parts that exclude its own fold; the
    rows are replicated once per such part (x(k-1), bounded by k) and ranked
    per (outer_fold, label) with the fold-specific salt.
    """
    others = F.filter(F.array(*[F.lit(i) for i in range(k_outer)]), lambda x: x != F.col(fold_col))
    parts = df.withColumn("outer_fold", F.explode(others))
    salt = (F.lit(seed) + F.col("outer_fold")).cast("string")
    return (hash_rank(parts, ["outer_fold", label], key, salt)
            .withColumn("inner_fold", ((F.col(_RANK) - 1) % k_inner).cast("int")).drop(_RANK))


def stratified_downsample(df: DataFrame, ratio: float, label: str, key: str = "id",
                          seed=42, hex_digits: int = 4) -> DataFrame:
    """Exact stratified sample of ceil(ratio * N) rows.

    Class quotas: floor of the proportional share, remaining rows to the
    classes with the largest remainders (ties: smaller class value).  Rows
    are taken in hash order inside each class.  The quota table has one row
    per class (bounded by the label domain).
    """
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    w_all = Window.partitionBy()
    q = (classes
         .withColumn("_N", F.sum("_nc").over(w_all))   # window over the tiny class table
         .withColumn("_nsel", F.ceil(F.lit(float(ratio)) * F.col("_N")))
         .withColumn("_exact", F.col("_nsel") * F.col("_nc") / F.col("_N"))
         .withColumn("_base", F.floor("_exact"))
         .withColumn("_rem", F.col("_exact") - F.col("_base"))
         .withColumn("_left", F.col("_nsel") - F.sum("_base").over(w_all))
         .withColumn("_order", F.row_number().over(Window.orderBy(F.col("_rem").desc(), F.col(label))))
         .select(label, (F.col("_base") + F.when(F.col("_order") <= F.col("_left"), 1).otherwise(0))
                 .cast("long").alias("_quota")))
    ranked = hash_rank(df, [label], key, seed, hex_digits)
    return (null_safe_join(ranked, q, [label], broadcast=True)
                  .where(F.col(_RANK) <= F.col("_quota")).drop(_RANK, "_quota"))


def seeded_sample(df: DataFrame, n: int, key: str = "id", seed=42) -> DataFrame:
    """S3: n rows without replacement, seeded (TakeOrderedAndProject; the limit is the feature)."""
    return df.orderBy(_hash(key, seed), F.col(key)).limit(n)
