"""Distributed exact ranks without a single-partition window.

``Window.orderBy(v)`` with no ``partitionBy`` moves every row into one task.
Instead, the rank primitive works on a tie-collapsed *value table* and a
bounded set of range buckets:

1. ``groupBy(strata, v)`` with partial (map-side) aggregation collapses ties —
   a value held by a third of all rows becomes a single row here;
2. quantile split points of ``v`` (``percentile_approx``, B ~ 4 x shuffle
   partitions, collected as literals) give a deterministic, monotone bucket id;
3. bucket totals (|strata| x B rows) -> running offsets by a window over that
   small table -> broadcast join;
4. inside a bucket, a ``partitionBy(strata, bucket).orderBy(v)`` running sum
   gives the count before each value.

Ranks are joined back to rows by value with a hot/cold split: values that at
least N / ``max_hot`` of the rows have (so at most ``max_hot`` of them) are
broadcast, the rest go through a regular shuffle join in which no key holds
more than N / ``max_hot`` rows.  AUC, KS and fold assignment read the value
table directly and never join back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.normal import probit
from rankforge.schema import GAUSS_CLIP
from rankforge.operators.joins import null_safe_join
from rankforge.session import default_buckets, stored

BUCKET = "_bucket"


@dataclass
class Splits:
    points: list[float]
    total: int
    sums: dict | None = None


def value_table(df: DataFrame, value: str, strata=(), label: str | None = None,
                extra_sums: dict[str, Column] | None = None) -> DataFrame:
    """One row per (strata, value): ``n`` rows, ``npos`` positives (if label)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if label is not None:
        aggs.append(F.sum(F.col(label).cast("long")).alias("npos"))
    for name, expr in (extra_sums or {}).items():
        aggs.append(F.sum(expr).alias(name))
    return df.where(F.col(value).isNotNull()).groupBy(*strata, value).agg(*aggs)


def quantile_splits(table: DataFrame, value: str, n_buckets: int,
                    count_col: str | None = "n", sum_cols=()) -> Splits:
    """Distinct split points over the distinct values, plus the row total and
    any requested column totals — all in one job over the value table."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    aggs = [F.percentile_approx(F.col(value).cast("double"), probs, 10 * n_buckets).alias("q")]
    aggs.append((F.sum(count_col) if count_col else F.count(F.lit(1))).alias("total"))
    aggs += [F.sum(c).alias(f"sum_{c}") for c in sum_cols]
    row = table.agg(*aggs).first()
    pts = sorted({float(x) for x in (row["q"] or []) if x is not None and not math.isnan(x)})
    return Splits(pts, int(row["total"] or 0), {c: row[f"sum_{c}"] or 0 for c in sum_cols})


def bucketize(df: DataFrame, value: str, points: list[float], out: str = BUCKET) -> DataFrame:
    """Monotone bucket id = number of split points <= v (JVM binary search)."""
    if not points:
        return df.withColumn(out, F.lit(0))
    tmp = "_bucket_v"
    b = Bucketizer(splits=[-math.inf] + list(points) + [math.inf],
                   inputCol=tmp, outputCol=out, handleInvalid="keep")
    return (b.transform(df.withColumn(tmp, F.col(value).cast("double")))
            .withColumn(out, F.col(out).cast("int")).drop(tmp))


def prefix_sums(table: DataFrame, value: str, strata, sum_cols: list[str],
                splits: Splits | None = None, n_buckets: int | None = None) -> DataFrame:
    """Add ``before_<c>``: sum of ``c`` over rows of the same stratum with a smaller value.

    ``table`` must hold one row per (strata, value).  Requires a bounded number
    of strata (folds, models, candidates): the offset table has |strata| x B rows.
    """
    strata = list(strata)
    if splits is None:
        splits = quantile_splits(table, value, n_buckets or default_buckets(table.sparkSession))
    tb = bucketize(table, value, splits.points)
    totals = tb.groupBy(*strata, BUCKET).agg(*[F.sum(c).alias(c) for c in sum_cols])
    w_off = Window.partitionBy(*strata).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*strata, BUCKET, *[
        F.coalesce(F.sum(c).over(w_off), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    w_in = Window.partitionBy(*strata, BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    # offsets: |strata| x B rows, bounded by construction -> broadcast
    out = null_safe_join(tb, offsets, [*strata, BUCKET], broadcast=True)
    out = out.withColumns({
        f"before_{c}": F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(w_in), F.lit(0))
        for c in sum_cols})
    return out.drop(BUCKET, *[f"_off_{c}" for c in sum_cols])


def gauss_of_pct(pct: Column, eps: float = GAUSS_CLIP) -> Column:
    """W3 from W2: normal quantile of the percentile rank, kept off 0 and 1; NULL stays NULL."""
    return F.when(pct.isNotNull(), probit(F.least(F.greatest(pct, F.lit(eps)), F.lit(1.0 - eps))))


def rank_table(df: DataFrame, value: str, strata=(), label: str | None = None,
               n_buckets: int | None = None, splits: Splits | None = None,
               eps: float = GAUSS_CLIP) -> tuple[DataFrame, Splits]:
    """Per distinct (strata, value): n, avg_rank (ties averaged), pct_rank, gauss_rank."""
    t = value_table(df, value, strata, label)
    if splits is None:
        splits = quantile_splits(t, value, n_buckets or default_buckets(df.sparkSession))
    t = prefix_sums(t, value, strata, ["n"], splits)
    t = _with_totals(t, strata, "n", splits.total)
    t = t.withColumn("avg_rank", F.col("before_n") + (F.col("n") + F.lit(1)) / F.lit(2.0))
    t = t.withColumn("pct_rank", (F.col("avg_rank") - F.lit(0.5)) / F.col("total_n"))
    t = t.withColumn("gauss_rank", gauss_of_pct(F.col("pct_rank"), eps))
    return t, splits


def _with_totals(t: DataFrame, strata, col: str, total: int) -> DataFrame:
    """Attach the per-stratum total of ``col``: a literal when there are no strata
    (known from the split-point job), else a broadcast one-row-per-stratum table."""
    if not strata:
        return t.withColumn(f"total_{col}", F.lit(int(total)))
    tot = t.groupBy(*strata).agg(F.sum(col).alias(f"total_{col}"))
    return null_safe_join(t, tot, list(strata), broadcast=True)


def attach_by_value(rows: DataFrame, table: DataFrame, keys: list[str], payload: list[str],
                    max_hot: int = 10000) -> DataFrame:
    """Left-join ``payload`` columns of a per-value table (one row per key) back to rows, skew-safe.

    A key is hot if at least ``ceil(rows / max_hot)`` of the *rows to be joined*
    have it, whether the table knows it or not; at most ``max_hot`` such keys
    exist, so they are attached (with a NULL payload if unknown) by a broadcast
    join.  The other keys have fewer rows each and go through one shuffle join.
    NULL is a key like any other.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1))).first()[0]
    hot = null_safe_join(counts.where(F.col("_n") >= _hot_from(total, max_hot)).drop("_n"), table.select(*keys, *payload), keys, "left")
    return _attach_spread(rows, table, hot, keys, payload)


def _hot_from(total: int, max_hot: int) -> int:
    """Rows from which a key is hot; at most ``max_hot`` keys have as many."""
    return max(2, math.ceil(max(total, 1) / max_hot))


def _attach_spread(rows: DataFrame, table: DataFrame, hot: DataFrame, keys: list[str], payload: list[str],
                   unknown: Column | None = None) -> DataFrame:
    """``payload`` of ``hot`` by a broadcast join, of ``table`` by a shuffle join for all other keys.
    Rows that are ``unknown`` to the table are spread as hot ones are."""
    base_cols = list(rows.columns)
    known = table.select(*keys, *[F.col(p).alias(f"_c_{p}") for p in payload])
    hot = hot.select(*keys, *[F.col(p).alias(f"_h_{p}") for p in payload], F.lit(True).alias("_hot"))
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.lit(1) + F.pmod(F.xxhash64(*[F.col(c) for c in base_cols]), F.lit(salts)).cast("int")
    tagged = null_safe_join(rows, hot, keys, "left", broadcast=True)
    away = F.col("_hot") if unknown is None else F.col("_hot") | unknown
    tagged = tagged.withColumn("_salt", F.when(away, spread).otherwise(F.lit(0)))
    joined = null_safe_join(tagged, known.withColumn("_salt", F.lit(0)), [*keys, "_salt"], "left")
    return joined.select(*base_cols, *[
        F.when(F.col("_hot"), F.col(f"_h_{p}")).otherwise(F.col(f"_c_{p}")).alias(p) for p in payload])


def with_ranks(df: DataFrame, value: str, strata=(), out_prefix: str | None = None,
               kinds=("avg_rank", "pct_rank"), n_buckets: int | None = None,
               max_hot: int = 10000) -> DataFrame:
    """W1/W2/W3 per row: average-tie rank, percentile rank, Gauss rank of ``value``."""
    t, splits = rank_table(df, value, strata, None, n_buckets)
    prefix = out_prefix if out_prefix is not None else f"{value}_"
    payload = t.select(*strata, value, "n", *[F.col(k).alias(prefix + k) for k in kinds])
    return attach_by_value(df, payload, [*strata, value], [prefix + k for k in kinds], max_hot)


def percentile_rank_columns(df: DataFrame, cols: list[str], strata=(), prefix: str = "r_",
                            kind: str = "pct_rank", n_buckets: int | None = None,
                            max_hot: int = 10000, eps: float = GAUSS_CLIP, table: DataFrame | None = None) -> DataFrame:
    """Add ``{prefix}{c}`` = percentile (or Gauss) rank of each column, all columns at once.

    1. one job: per-column split points (``percentile_approx``) and counts;
    2. each column bucketed with its own splits (multi-column Bucketizer), the
       columns stacked to (model, value, bucket) and tie-collapsed in ONE group-by;
    3. per-(model, bucket) offsets (bounded: |cols| x |strata| x B rows) +
       in-bucket running sums give the average rank of every distinct value;
    4. that value table is stored, counted per column, and joined back: a plain
       broadcast when the exact count is within ``max_hot``, else the skew-safe
       hot/cold join.  The table counts the rows of every value, so the hot ones are
       known from it and the rows are not counted again for each column.

    ``table``: the ``percentile_rank_table`` of the same rows, if there is one already.
    """
    strata = list(strata)
    t = percentile_rank_table(df, cols, strata, kind, n_buckets, eps) if table is None else table
    if kind not in t.columns:
        t = t.withColumn(kind, gauss_of_pct(F.col("pct_rank"), eps))
    sizes = {r["model"]: r for r in
             t.groupBy("model").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n")).collect()}      # one row per column
    out = df
    for c in cols:
        m = t.where(F.col("model") == c).select(*strata, F.col("value").alias(c), "n",
                                                F.col(kind).alias(prefix + c))
        values, n = (sizes[c]["values"], sizes[c]["n"]) if c in sizes else (0, 0)
        if values <= max_hot:
            out = null_safe_join(out, m.drop("n"), [*strata, c], "left", broadcast=True)
        else:
            # rows without a value are in no table, so they add nothing to what makes a value hot
            out = _attach_spread(out, m, m.where(F.col("n") >= _hot_from(n, max_hot)), [*strata, c], [prefix + c], F.col(c).isNull())
    return out


def percentile_rank_table(df: DataFrame, cols: list[str], strata=(), kind: str = "pct_rank",
                          n_buckets: int | None = None, eps: float = GAUSS_CLIP) -> DataFrame:
    """(model, strata..., value, n, rank by ``kind``): every distinct value of each column once, stored."""
    strata = list(strata)
    spark = df.sparkSession
    B = n_buckets or default_buckets(spark)
    probs = [i / B for i in range(1, B)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 10 * B).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()
    splits = {c: sorted({float(x) for x in (row[f"q{i}"] or []) if x is not None and not math.isnan(x)})
              for i, c in enumerate(cols)}
    tmp_in = {c: f"_rk_in{i}" for i, c in enumerate(cols)}
    tmp_b = {c: f"_rk_b{i}" for i, c in enumerate(cols)}
    d = df.select(*strata, *[F.col(c).cast("double").alias(tmp_in[c]) for c in cols])
    d = Bucketizer(splitsArray=[[-math.inf] + splits[c] + [math.inf] for c in cols],
                   inputCols=[tmp_in[c] for c in cols], outputCols=[tmp_b[c] for c in cols],
                   handleInvalid="keep").transform(d)
    args = ", ".join(f"'{c}', `{tmp_in[c]}`, CAST(`{tmp_b[c]}` AS INT)" for c in cols)
    long = d.select(*strata, F.expr(f"stack({len(cols)}, {args}) AS (model, value, {BUCKET})"))
    t = long.where(F.col("value").isNotNull()).groupBy("model", *strata, BUCKET, "value") \
            .agg(F.count(F.lit(1)).alias("n"))
    key = ["model", *strata]
    bt = t.groupBy(*key, BUCKET).agg(F.sum("n").alias("_bn"))
    w_off = Window.partitionBy(*key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offs = bt.select(*key, BUCKET, F.coalesce(F.sum("_bn").over(w_off), F.lit(0)).alias("_off"))
    tot = bt.groupBy(*key).agg(F.sum("_bn").alias("_tot"))
    w_in = Window.partitionBy(*key, BUCKET).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    # offs: |cols| x |strata| x B rows; tot: |cols| x |strata| rows -> bounded broadcasts
    t = (null_safe_join(null_safe_join(t, offs, [*key, BUCKET], broadcast=True), tot, key, broadcast=True)
          .withColumn("avg_rank", F.col("_off") + F.coalesce(F.sum("n").over(w_in), F.lit(0))
                      + (F.col("n") + F.lit(1)) / F.lit(2.0)))
    t = t.withColumn("pct_rank", (F.col("avg_rank") - F.lit(0.5)) / F.col("_tot"))
    if kind == "gauss_rank":
        t = t.withColumn("gauss_rank", gauss_of_pct(F.col("pct_rank"), eps))
    return stored(t.select("model", *strata, "value", "n", kind), "ranks")
