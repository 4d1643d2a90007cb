"""Imputation and encoding.

Encoder state is a small DataFrame ``(col, level, ...)`` produced by one
group-by; it is attached to rows with ``attach_by_value`` (hot levels
broadcast with a proven bound, the rest by a shuffle join), so a level that
holds a third of all rows never lands in one reducer.

Out-of-fold target encoding (E8/E9) is one pass for any k: aggregate per
(col, level, fold), then "level total minus own fold" gives the statistics
of the training part of each fold (SURVEY 4.4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.joins import null_safe_join
from rankforge.operators.rank import attach_by_value, prefix_sums, quantile_splits, value_table
from rankforge.schema import (CATEGORICAL_COLUMNS, LABEL_MISSING, MODE_MISSING, TE_MISSING,
                              TE_PAIRS, TE_SMOOTHING)
from rankforge.session import cut_lineage, default_buckets, stored


# ---------------------------------------------------------------------------------
# E5: discrete levels
# ---------------------------------------------------------------------------------
def discrete_levels(df: DataFrame, cat_cols=CATEGORICAL_COLUMNS, pairs=TE_PAIRS,
                    token: str = TE_MISSING) -> dict[str, Column]:
    """Level columns: each categorical with NULL -> token, plus pair levels ``a_b``."""
    present = [c for c in cat_cols if c in df.columns]
    lv = {c: F.coalesce(F.col(c).cast("string"), F.lit(token)) for c in present}
    out = dict(lv)
    for a, b in pairs:
        if a in df.columns and b in df.columns:
            out[f"{a}_{b}"] = F.concat(lv[a], F.lit("_"), lv[b])
    return out


def stack_levels(df: DataFrame, level_cols: list[str], keep: list[str]) -> DataFrame:
    """Wide level columns -> long (keep..., col, level) with one ``stack`` (no join)."""
    args = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in level_cols)
    return df.select(*keep, F.expr(f"stack({len(level_cols)}, {args}) AS (col, level)"))


# ---------------------------------------------------------------------------------
# Global smoothed target encoding and frequency encoding
# ---------------------------------------------------------------------------------
def target_encoding_map(df: DataFrame, level_cols: list[str], label: str,
                        smoothing: float = TE_SMOOTHING) -> DataFrame:
    """(col, level, n, te, freq): te = (sum y + m * mean y) / (n + m), freq = n / N."""
    long = stack_levels(df, level_cols, [label])
    a = long.groupBy("col", "level").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.col(label).cast("long")).alias("s"))
    tot = a.groupBy("col").agg(F.sum("n").alias("_N"), F.sum("s").alias("_S"))  # one row per col
    m = F.lit(float(smoothing))
    mean = F.col("_S") / F.col("_N")
    return (a.join(F.broadcast(tot), ["col"], "inner")
             .select("col", "level", "n",
                     ((F.col("s") + m * mean) / (F.col("n") + m)).alias("te"),
                     (F.col("n") / F.col("_N")).alias("freq"),
                     mean.alias("global_mean")))


# ---------------------------------------------------------------------------------
# Out-of-fold target and frequency encoding, one pass
# ---------------------------------------------------------------------------------
def oof_encoding_map(df: DataFrame, level_cols: list[str], label: str, fold_col: str = "fold",
                     smoothing: float = TE_SMOOTHING) -> DataFrame:
    """(col, level, fold, n, te, freq) computed from the rows NOT in ``fold``.

    Levels never seen outside their own fold get the training part's mean and
    frequency 0, as in the fold-by-fold original.
    """
    long = stack_levels(df, level_cols, [fold_col, label])
    a = long.groupBy("col", "level", fold_col).agg(F.count(F.lit(1)).alias("n"),
                                                   F.sum(F.col(label).cast("long")).alias("s"))
    w_level = Window.partitionBy("col", "level")            # <= k rows per partition
    a = a.withColumns({"_Tn": F.sum("n").over(w_level), "_Ts": F.sum("s").over(w_level)})
    per_fold = a.groupBy("col", fold_col).agg(F.sum("n").alias("_Fn"), F.sum("s").alias("_Fs"))
    per_col = a.groupBy("col").agg(F.sum("n").alias("_An"), F.sum("s").alias("_As"))
    # per_fold: |cols| x k rows; per_col: |cols| rows -> bounded broadcasts
    j = (a.join(F.broadcast(per_fold), ["col", fold_col], "inner")
          .join(F.broadcast(per_col), ["col"], "inner"))
    n_tr = F.col("_Tn") - F.col("n")
    s_tr = F.col("_Ts") - F.col("s")
    part_n = F.col("_An") - F.col("_Fn")
    part_mean = (F.col("_As") - F.col("_Fs")) / part_n
    m = F.lit(float(smoothing))
    te = F.when(n_tr > 0, (s_tr + m * part_mean) / (n_tr + m)).otherwise(part_mean)
    return j.select("col", "level", fold_col, "n", te.alias("te"),
                    (n_tr / part_n).alias("freq"))


def apply_oof_encoding(rows: DataFrame, enc_map: DataFrame, level_exprs: dict[str, Column],
                       fold_col: str = "fold", max_hot: int = 10000) -> DataFrame:
    """Attach ``{col}_te`` / ``{col}_freq`` for each level column, keyed by (level, fold).

    The map is stored first: its sizes and every column read it once more.
    """
    enc_map = cut_lineage(enc_map)
    stats = map_stats(enc_map)
    out = rows
    for name, expr in level_exprs.items():
        lvl = f"_lvl_{name}"
        out = out.withColumn(lvl, expr)
        m = (enc_map.where(F.col("col") == name)
             .select(F.col("level").alias(lvl), fold_col,
                     F.col("te").alias(f"{name}_te"), F.col("freq").alias(f"{name}_freq")))
        out = attach_map(out, m, [lvl, fold_col], [f"{name}_te", f"{name}_freq"],
                         stats.get(name, (0, None))[0], max_hot).drop(lvl)
    return out


def map_stats(enc_map: DataFrame) -> dict:
    """col -> (map rows, global mean) in ONE small job over the encoder map."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    has_gm = "global_mean" in enc_map.columns
    if has_gm:
        aggs.append(F.first("global_mean").alias("gm"))
    return {r["col"]: (int(r["rows"]), r["gm"] if has_gm else None)
            for r in enc_map.groupBy("col").agg(*aggs).collect()}        # one row per level column


def attach_map(rows: DataFrame, m: DataFrame, keys: list[str], payload: list[str], map_rows: int,
               max_hot: int = 10000) -> DataFrame:
    """Attach an encoder map: a plain broadcast left join when its counted size is
    within ``max_hot`` rows (a proven bound), else the skew-safe hot/cold join."""
    if map_rows <= max_hot:
        return null_safe_join(rows, m, keys, "left", broadcast=True)
    return attach_by_value(rows, m, keys, payload, max_hot)


# ---------------------------------------------------------------------------------
# Frozen map transform with defaults for unseen levels
# ---------------------------------------------------------------------------------
def apply_frozen_encoding(rows: DataFrame, enc_map: DataFrame, level_exprs: dict[str, Column],
                          max_hot: int = 10000, stats: dict | None = None) -> DataFrame:
    """Unseen level -> global mean (te) / 0.0 (freq).  The map is stored first, unless its ``stats`` are known."""
    if stats is None:
        enc_map = cut_lineage(enc_map)
        stats = map_stats(enc_map)
    gm = {k: v[1] for k, v in stats.items()}
    out = rows
    for name, expr in level_exprs.items():
        lvl = f"_lvl_{name}"
        out = out.withColumn(lvl, expr)
        m = (enc_map.where(F.col("col") == name)
             .select(F.col("level").alias(lvl),
                     F.col("te").alias(f"{name}_te"), F.col("freq").alias(f"{name}_freq")))
        out = attach_map(out, m, [lvl], [f"{name}_te", f"{name}_freq"], stats.get(name, (0, None))[0], max_hot)
        out = out.withColumns({
            f"{name}_te": F.coalesce(F.col(f"{name}_te"), F.lit(gm.get(name))),
            f"{name}_freq": F.coalesce(F.col(f"{name}_freq"), F.lit(0.0)),
        }).drop(lvl)
    return out


# ---------------------------------------------------------------------------------
# Median impute (exact, distributed);  E2: mode impute
# ---------------------------------------------------------------------------------
def exact_medians(df: DataFrame, cols: list[str], n_buckets: int | None = None) -> DataFrame:
    """(col, median) — pandas median (mean of the two middle values), no single-task sort.

    Values of all columns are stacked to (col, value); the tie-collapsed value
    table with bucketed prefix sums locates the middle positions.
    """
    args = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.select(F.expr(f"stack({len(cols)}, {args}) AS (col, value)"))
    t = value_table(long, "value", ["col"])
    splits = quantile_splits(t, "value", n_buckets or default_buckets(df.sparkSession))
    t = prefix_sums(t, "value", ["col"], ["n"], splits)
    tot = t.groupBy("col").agg(F.sum("n").alias("_N"))            # one row per column
    t = t.join(F.broadcast(tot), ["col"], "inner")
    lo = F.floor((F.col("_N") + 1) / 2)                             # 1-based middle positions
    hi = F.floor(F.col("_N") / 2) + 1
    hit_lo = (F.col("before_n") < lo) & (lo <= F.col("before_n") + F.col("n"))
    hit_hi = (F.col("before_n") < hi) & (hi <= F.col("before_n") + F.col("n"))
    med = t.groupBy("col").agg(((F.max(F.when(hit_lo, F.col("value")))
                                 + F.max(F.when(hit_hi, F.col("value")))) / F.lit(2.0)).alias("median"))
    allcols = df.sparkSession.createDataFrame([(c,) for c in cols], "col string")
    return allcols.join(med, ["col"], "left")


def median_impute(train: DataFrame, apply_to: list[DataFrame], cols: list[str],
                  default: float = 0.0) -> list[DataFrame]:
    """Medians fitted on ``train`` (all-null column -> default) filled into every frame."""
    meds = {r["col"]: r["median"] for r in exact_medians(train, cols).collect()}  # one per column
    fill = {c: (meds.get(c) if meds.get(c) is not None else default) for c in cols}
    return [d.withColumns({c: F.coalesce(F.col(c), F.lit(float(v))) for c, v in fill.items()})
            for d in apply_to]


def modes(df: DataFrame, cols: list[str], default: str = MODE_MISSING) -> DataFrame:
    """(col, mode): most frequent non-null value, ties -> smallest; all-null -> default."""
    long = stack_levels(df, cols, []).where(F.col("level").isNotNull())
    cnt = long.groupBy("col", "level").agg(F.count(F.lit(1)).alias("n"))
    best = cnt.groupBy("col").agg(
        F.min_by("level", F.struct((-F.col("n")).alias("k"), F.col("level").alias("v"))).alias("mode"))
    allcols = df.sparkSession.createDataFrame([(c,) for c in cols], "col string")
    return allcols.join(best, ["col"], "left").select(
        "col", F.coalesce(F.col("mode"), F.lit(default)).alias("mode"))


def mode_impute(train: DataFrame, apply_to: list[DataFrame], cols: list[str],
                default: str = MODE_MISSING) -> list[DataFrame]:
    """Fill NULLs of categorical columns with the training mode."""
    fill = {r["col"]: r["mode"] for r in modes(train, cols, default).collect()}  # one per column
    return [d.withColumns({c: F.coalesce(F.col(c), F.lit(fill[c])) for c in cols}) for d in apply_to]


# ---------------------------------------------------------------------------------
# Label codes, ordinal codes, unseen classes
# ---------------------------------------------------------------------------------
def label_code_map(train: DataFrame, apply: DataFrame, cols: list[str],
                   token: str = LABEL_MISSING) -> DataFrame:
    """(col, level, code): sorted training classes 0..n-1; classes seen only in
    ``apply`` are appended after them in sorted order (J3 = those classes)."""
    tr = stack_levels(train.select([F.coalesce(F.col(c).cast("string"), F.lit(token)).alias(c)
                                    for c in cols]), cols, []).distinct()
    ap = stack_levels(apply.select([F.coalesce(F.col(c).cast("string"), F.lit(token)).alias(c)
                                    for c in cols]), cols, []).distinct()
    # The levels of ``apply`` alone get their numbers behind all of ``train``
    unseen = ap.join(tr, ["col", "level"], "left_anti")
    return number_levels(tr.withColumn("seen", F.lit(True)).unionByName(unseen.withColumn("seen", F.lit(False))))


def number_levels(levels: DataFrame) -> DataFrame:
    """(col, level, seen) -> plus ``code``: place of the level in its column, seen ones first.

    No task numbers a whole vocabulary: the levels are dealt out by range and
    stored, the ranges' counts (|cols| x partitions rows) give offsets, and rows
    are numbered within their range.
    """
    dealt = cut_lineage(levels.repartitionByRange("col", F.col("seen").desc(), "level")
                        .withColumn("_p", F.spark_partition_id()))
    counts = dealt.groupBy("col", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("col").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("col", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = Window.partitionBy("col", "_p").orderBy(F.col("seen").desc(), "level")
    return (dealt.join(F.broadcast(offsets), ["col", "_p"])
            .withColumn("code", (F.col("_off") + F.row_number().over(own) - 1).cast("int"))
            .select("col", "level", "code", "seen"))


def extend_codes(code_map: DataFrame, rows: DataFrame, cols: list[str], token: str = LABEL_MISSING) -> DataFrame:
    """E3 on new rows: known levels keep their codes, levels only in ``rows`` follow in sorted order."""
    new = stack_levels(rows.select([F.coalesce(F.col(c).cast("string"), F.lit(token)).alias(c) for c in cols]), cols, [])
    unseen = new.distinct().join(code_map.select("col", "level"), ["col", "level"], "left_anti")
    return number_levels(code_map.select("col", "level", F.lit(True).alias("seen"))
                         .unionByName(unseen.withColumn("seen", F.lit(False))))


def unseen_levels(train: DataFrame, apply: DataFrame, cols: list[str],
                  token: str = LABEL_MISSING) -> DataFrame:
    """Classes present in ``apply`` but not in ``train`` (left anti join)."""
    tr = stack_levels(train.select([F.coalesce(F.col(c).cast("string"), F.lit(token)).alias(c)
                                    for c in cols]), cols, []).distinct()
    ap = stack_levels(apply.select([F.coalesce(F.col(c).cast("string"), F.lit(token)).alias(c)
                                    for c in cols]), cols, []).distinct()
    return ap.join(tr, ["col", "level"], "left_anti")


def apply_codes(rows: DataFrame, code_map: DataFrame, cols: list[str], token: str | None,
                unknown: int | None = None, max_bytes: int = 8 << 20, sizes: dict | None = None) -> DataFrame:
    """Replace each categorical with its code (E3), unseen -> ``unknown`` (E4: -1).

    A column's vocabulary is broadcast if its strings and codes have at most
    ``max_bytes``, else joined skew-safe.
    """
    out = rows
    if sizes is None:
        code_map = cut_lineage(code_map)
        sizes = {r["col"]: int(r["size"]) for r in code_map.groupBy("col").agg(
            F.sum(F.octet_length("level") + 16).alias("size")).collect()}   # one per column
    for c in cols:
        m = code_map.where(F.col("col") == c).select(F.col("level").alias(f"_lv_{c}"),
                                                     F.col("code").alias(f"_code_{c}"))
        key = F.col(c).cast("string") if token is None else F.coalesce(F.col(c).cast("string"), F.lit(token))
        out = out.withColumn(f"_lv_{c}", key)
        out = (null_safe_join(out, m, [f"_lv_{c}"], "left", broadcast=True) if sizes.get(c, 0) <= max_bytes
               else attach_by_value(out, m, [f"_lv_{c}"], [f"_code_{c}"]))
        out = (out.withColumn(c, F.col(f"_code_{c}") if unknown is None
                              else F.coalesce(F.col(f"_code_{c}"), F.lit(unknown)))
                  .drop(f"_lv_{c}", f"_code_{c}"))
    return out


def ordinal_code_map(train: DataFrame, cols: list[str]) -> DataFrame:
    """Sorted training categories -> 0..n-1 (apply with ``unknown=-1``)."""
    tr = stack_levels(train, cols, []).where(F.col("level").isNotNull()).distinct()
    return number_levels(tr.withColumn("seen", F.lit(True))).drop("seen")


# ---------------------------------------------------------------------------------
# Standardise after zero fill (population std);  E12: category index
# ---------------------------------------------------------------------------------
def _zero_filled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))


def zero_fill_stats(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Column -> mean and population deviation (1 if it is 0) after zero fill; one job."""
    row = train.agg(*[F.avg(_zero_filled(c)).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(_zero_filled(c)).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] if row[f"s_{c}"] else 1.0) for c in cols}


def standardized(stats: dict[str, tuple[float, float]]) -> dict[str, Column]:
    return {c: (_zero_filled(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()}


def standardize(train: DataFrame, apply_to: list[DataFrame], cols: list[str]) -> list[DataFrame]:
    """Zero fill, then (x - mean) / deviation of the training rows."""
    z = standardized(zero_fill_stats(train, cols))
    return [d.withColumns(z) for d in apply_to]


def category_index(train: DataFrame, apply: DataFrame, cols: list[str]) -> DataFrame:
    """Alphabetical category codes ``{col}_idx``; unseen and NULL -> number of levels.

    Spark ML's StringIndexer would bring every level to the driver; here only
    the number of levels of each column does.
    """
    codes = cut_lineage(ordinal_code_map(train, cols))
    n = {r["col"]: int(r["n"]) for r in codes.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()}
    idx = {c: f"{c}_idx" for c in cols}
    out = apply.withColumns({i: F.col(c).cast("string") for c, i in idx.items()})
    out = apply_codes(out, codes.replace(idx, subset=["col"]), list(idx.values()), token=None)
    return out.withColumns({i: F.coalesce(F.col(i), F.lit(n.get(c, 0))).cast("double") for c, i in idx.items()})


# ---------------------------------------------------------------------------------
# Train-fitted frequency maps;  G15: cohort residual
# ---------------------------------------------------------------------------------
def joint_profile_key(cols=CATEGORICAL_COLUMNS, token: str = "nan") -> Column:
    """Joint key ``gender_stress_impact`` (missing renders as 'nan', as str() of NaN)."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit(token)) for c in cols])


def frequency_map(train: DataFrame, key: Column, name: str = "key") -> tuple[DataFrame, int]:
    """(key, n, freq) over the training rows: normalised value counts, and N."""
    cnt = train.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = int(cnt.agg(F.sum("n")).first()[0] or 0)   # one scalar
    return cnt.withColumn("freq", F.col("n") / F.lit(float(max(total, 1)))), total


def apply_frequency(rows: DataFrame, fmap: DataFrame, key: Column, out: str,
                    max_hot: int = 10000) -> DataFrame:
    """Attach a fitted frequency (unseen -> NULL)."""
    k = f"_fk_{out}"
    m = fmap.select(F.col(fmap.columns[0]).alias(k), F.col("freq").alias(out))
    return attach_by_value(rows.withColumn(k, key), m, [k], [out], max_hot).drop(k)


def frequency_maps(train: DataFrame, cols: list[str]) -> DataFrame:
    """(col, value, n, freq): G14 of several numeric columns from one grouping."""
    args = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = train.select(F.expr(f"stack({len(cols)}, {args}) AS (col, value)")).where("value IS NOT NULL")
    n = long.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy("col").agg(F.sum("n").alias("_all"))                # a row per column
    return n.join(F.broadcast(total), "col").select("col", "value", "n", (F.col("n") / F.col("_all")).alias("freq"))


def apply_frequencies(rows: DataFrame, maps: DataFrame, cols: list[str], max_hot: int = 10000) -> DataFrame:
    """Attach ``{col}_freq`` for each column (unseen -> NULL); the maps are stored first."""
    maps = stored(maps, "frequencies")
    sizes = {r["col"]: int(r["n"]) for r in maps.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()}   # a row per column
    for c in cols:
        m = maps.where(F.col("col") == c).select(F.col("value").alias(c), F.col("freq").alias(f"{c}_freq"))
        rows = attach_map(rows, m, [c], [f"{c}_freq"], sizes.get(c, 0), max_hot)
    return rows


def null_safe_key(cols: list[str]) -> Column:
    """A non-null, injective string key over ``cols`` (NULL fields are omitted by
    ``to_json``), so NULL cohorts join like window partitions do."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def cohort_residual(df: DataFrame, value: str, by: list[str], out: str | None = None,
                    max_hot: int = 10000) -> DataFrame:
    """``v - avg(v)`` over the cohort ``by``.

    A group-by (partial aggregation, skew-safe) plus a hot/cold join back,
    instead of ``avg().over(partitionBy(by))``: a cohort holding a third of all
    rows would otherwise be one window partition in one task.
    """
    out = out or f"{value}_cohort_resid"
    k = "_cohort_key"
    means = df.groupBy(*by).agg(F.avg(value).alias("_cm")).withColumn(k, null_safe_key(by))
    j = attach_by_value(df.withColumn(k, null_safe_key(by)), means.select(k, "_cm"), [k], ["_cm"], max_hot)
    return j.withColumn(out, F.col(value) - F.col("_cm")).drop(k, "_cm")
