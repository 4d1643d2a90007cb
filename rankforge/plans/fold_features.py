"""The feature plans of all folds of a cross-validation, fitted together.

A training part is everything but one fold, so its statistics are the total
less that fold's.  One table of (column, value) with a count per fold gives the
medians of every training part; one of (column, level, fold) its codes; moments
per fold are merged over the other folds.  The inner folds of all training parts
are dealt out in one pass, and one table of (part, column, level, inner fold)
gives every out-of-fold and every frozen encoding.

The results equal those of ``models.fit_fold_features`` on each training part
alone (tested); the number of jobs does not depend on the number of folds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators import encode as EN
from rankforge.operators import models as MO
from rankforge.operators import sampling as SA
from rankforge.operators.rank import prefix_sums, quantile_splits
from rankforge.schema import CATEGORICAL_COLUMNS, LABEL_MISSING, NUMERIC_COLUMNS, TE_SMOOTHING
from rankforge.operators import features as FE
from rankforge.session import default_buckets, stored, together

PART = "outer_fold"


def fold_value_table(df: DataFrame, cols: list[str], k: int, fold: str = "fold") -> DataFrame:
    """(col, value, n, n_0..n_{k-1}): how often a column has a value, in all and outside each fold."""
    args = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.select(fold, F.expr(f"stack({len(cols)}, {args}) AS (col, value)")).where("value IS NOT NULL")
    own = [F.count_if(F.col(fold) == j) for j in range(k)]
    return long.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"), *[(F.count(F.lit(1)) - c).alias(f"n_{j}") for j, c in enumerate(own)])


def ranked_values(table: DataFrame, k: int) -> DataFrame:
    """The value table with ``before_n_j``, how many rows outside fold j have a smaller
    value of the column, and ``all_n_j``, how many have any."""
    counts = [f"n_{j}" for j in range(k)]
    splits = quantile_splits(table, "value", default_buckets(table.sparkSession))
    t = prefix_sums(table, "value", ["col"], counts, splits)
    totals = table.groupBy("col").agg(*[F.sum(c).alias(f"all_{c}") for c in counts])          # a row per column
    return t.join(F.broadcast(totals), "col")


def fold_medians(ranked: DataFrame, k: int) -> list[dict[str, float]]:
    """Column -> median outside fold j, for every j: the mean of the two middle values."""
    def middle(j: int, at: Column) -> Column:
        hit = (F.col(f"before_n_{j}") < at) & (at <= F.col(f"before_n_{j}") + F.col(f"n_{j}"))
        return F.max(F.when(hit, F.col("value")))

    def median(j: int) -> Column:
        n = F.col(f"all_n_{j}")
        return (middle(j, F.floor((n + 1) / 2)) + middle(j, F.floor(n / 2) + 1)) / F.lit(2.0)

    rows = ranked.groupBy("col").agg(*[median(j).alias(f"m_{j}") for j in range(k)]).collect()  # a row per column
    return [{r["col"]: r[f"m_{j}"] for r in rows} for j in range(k)]


def fold_moments(df: DataFrame, cols: list[str], k: int, fold: str = "fold") -> list[dict[str, tuple[float, float]]]:
    """Column -> mean and population deviation (1 if it is 0) of the zero-filled values
    outside fold j, for every j; the folds' own moments are merged pairwise."""
    z = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    rows = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m_{c}") for c, v in z.items()],
                                *[F.var_pop(v).alias(f"v_{c}") for c, v in z.items()]).collect()   # a row per fold

    def merged(c: str, j: int) -> tuple[float, float]:
        n, mean, square = 0, 0.0, 0.0
        for r in rows:
            if r[fold] != j:
                d, total = r[f"m_{c}"] - mean, n + r["n"]
                square += r[f"v_{c}"] * r["n"] + d * d * n * r["n"] / total
                mean, n = mean + d * r["n"] / total, total
        return mean, (square / n) ** 0.5 if n and square > 0 else 1.0

    return [{c: merged(c, j) for c in cols} for j in range(k)]


def fold_codes(df: DataFrame, k: int, fold: str = "fold") -> DataFrame:
    """(part, col, level, code, seen): E3 for every training part at once; levels
    that stand in the part's own fold alone have the numbers behind the others and are not ``seen``."""
    filled = df.select(fold, *[F.coalesce(F.col(c).cast("string"), F.lit(LABEL_MISSING)).alias(c) for c in CATEGORICAL_COLUMNS])
    per = (EN.stack_levels(filled, CATEGORICAL_COLUMNS, [fold]).groupBy("col", "level")
           .agg(F.count_distinct(fold).alias("_folds"), F.first(fold).alias("_only")))
    parts = per.withColumn(PART, F.explode(F.array(*[F.lit(j) for j in range(k)])))
    seen = (F.col("_folds") > 1) | (F.col("_only") != F.col(PART))
    keyed = parts.select(F.concat_ws("\x1f", PART, "col").alias("col"), "level", seen.alias("seen"))
    both = F.split("col", "\x1f")
    return EN.number_levels(keyed).select(both[0].cast("int").alias(PART), both[1].alias("col"), "level", "code", "seen")


def part_encodings(parts: DataFrame, label: str, smoothing: float = TE_SMOOTHING) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold maps (part, col, level, _inner, n, te, freq) and frozen maps (part, col, level, n, te,
    freq, global_mean) of every training part, from one grouping."""
    long = EN.stack_levels(parts.select(PART, "_inner", label, *[F.col(f"lvl_{c}").alias(c) for c in MO.LEVEL_COLS]),
                           MO.LEVEL_COLS, [PART, "_inner", label])
    a = stored(long.groupBy(PART, "col", "level", "_inner").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("s")), "encodings")
    key, m = [PART, "col"], F.lit(float(smoothing))
    inner = a.groupBy(*key, "_inner").agg(F.sum("n").alias("_Fn"), F.sum("s").alias("_Fs"))        # parts x columns x inner folds
    whole = a.groupBy(*key).agg(F.sum("n").alias("_An"), F.sum("s").alias("_As"))
    w = Window.partitionBy(*key, "level")                                                           # a row per inner fold
    j = (a.withColumns({"_n": F.sum("n").over(w) - F.col("n"), "_s": F.sum("s").over(w) - F.col("s")})
         .join(F.broadcast(inner), [*key, "_inner"]).join(F.broadcast(whole), key))
    rest = F.col("_An") - F.col("_Fn")
    mean = (F.col("_As") - F.col("_Fs")) / rest
    te = F.when(F.col("_n") > 0, (F.col("_s") + m * mean) / (F.col("_n") + m)).otherwise(mean)
    oof = j.select(*key, "level", "_inner", "n", te.alias("te"), (F.col("_n") / rest).alias("freq"))
    g = a.groupBy(*key, "level").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).join(F.broadcast(whole), key)
    mean = F.col("_As") / F.col("_An")
    frozen = g.select(*key, "level", "n", ((F.col("s") + m * mean) / (F.col("n") + m)).alias("te"), (F.col("n") / F.col("_An")).alias("freq"),
                      mean.alias("global_mean"))
    return oof, frozen


@dataclass
class FoldPlans:
    k: int
    rows: DataFrame                 # every row once, with its fold, features and levels
    parts: DataFrame                # every row once for each training part it is in, with its inner fold
    plans: dict[int, MO.FoldFeatures]
    oof: DataFrame                  # out-of-fold, frozen and code maps of all parts, stored
    frozen: DataFrame
    codes: DataFrame
    sizes: dict                     # ("oof", part, column) -> rows; ("frozen", ..) -> rows, global mean; ("codes", ..) -> bytes

    def train(self, j: int, first: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Training part j, encoded out of its inner folds; ``first`` is put on its rows while they are narrow."""
        d = self.parts.where(F.col(PART) == j).drop(PART)
        if first is not None:
            d = first(d)
        for c in MO.LEVEL_COLS:
            m = (self.oof.where((F.col(PART) == j) & (F.col("col") == c))
                 .select(F.col("level").alias(f"lvl_{c}"), "_inner", F.col("te").alias(f"{c}_te"), F.col("freq").alias(f"{c}_freq")))
            d = EN.attach_map(d, m, [f"lvl_{c}", "_inner"], [f"{c}_te", f"{c}_freq"], self.sizes["oof"].get((j, c), (0, None))[0])
        return self._finish(j, d.drop("_inner"))

    def _finish(self, j: int, d: DataFrame) -> DataFrame:
        sizes = {c: n for (p, c), (n, _) in self.sizes["codes"].items() if p == j}
        return MO.finish(self.plans[j], d, self.codes.where(F.col(PART) == j), sizes)

    def valid(self, j: int) -> DataFrame:
        """Fold j, encoded with the maps of its training part."""
        d = self.rows.where(F.col("fold") == j)
        stats = {c: v for (p, c), v in self.sizes["frozen"].items() if p == j}
        enc = EN.apply_frozen_encoding(d, self.plans[j].te_global, {c: F.col(f"lvl_{c}") for c in MO.LEVEL_COLS}, stats=stats)
        return self._finish(j, enc)

    def together(self, max_hot: int = 10000) -> DataFrame:
        """All training parts and their folds in one table, with ``part``, ``_inner`` (NULL in the
        fold itself), NULLs kept, category codes and encodings: every map is joined once for all parts."""
        def attach(d: DataFrame, m: DataFrame, keys: list[str], payload: list[str], kind: str, c: str) -> DataFrame:
            rows = sum(n for (_, col), (n, _) in self.sizes[kind].items() if col == c)
            return EN.attach_map(d, m, keys, payload, rows, max_hot)

        train, valid = self.parts, self.rows.withColumn(PART, F.col("fold"))
        for c in MO.LEVEL_COLS:
            lvl, out = f"lvl_{c}", [f"{c}_te", f"{c}_freq"]
            names = [F.col("level").alias(lvl), F.col("te").alias(out[0]), F.col("freq").alias(out[1])]
            train = attach(train, self.oof.where(F.col("col") == c).select(PART, "_inner", *names), [PART, lvl, "_inner"], out, "oof", c)
            valid = attach(valid, self.frozen.where(F.col("col") == c).select(PART, *names), [PART, lvl], out, "frozen", c)
            unseen = [F.when(F.col(PART) == p, F.lit(mean)) for (p, col), (_, mean) in self.sizes["frozen"].items() if col == c]
            valid = valid.withColumns({out[0]: F.coalesce(F.col(out[0]), *unseen), out[1]: F.coalesce(F.col(out[1]), F.lit(0.0))})
        d = train.unionByName(valid, allowMissingColumns=True)
        for c in CATEGORICAL_COLUMNS:
            d = d.withColumn("_lv", F.coalesce(F.col(c).cast("string"), F.lit(LABEL_MISSING)))
            m = self.codes.where(F.col("col") == c).select(PART, F.col("level").alias("_lv"), F.col("code").cast("double").alias("_code"))
            n = sum(size for (_, col), (size, _) in self.sizes["codes"].items() if col == c)
            d = EN.attach_map(d, m, [PART, "_lv"], ["_code"], n // 17, max_hot)            # a row has 17 bytes at least
            d = d.withColumn(c, F.col("_code")).drop("_lv", "_code")
        return d.withColumnRenamed(PART, "part")


def fit_folds(folds: DataFrame, label: str, k: int, inner_k: int = 5, seed: int = 42, extra_numeric=(), key: str = "id") -> FoldPlans:
    """Plans for every fold of ``folds`` (rows with a ``fold``, stored)."""
    spark = folds.sparkSession
    rows = stored(MO.base_features(folds), "fold-rows")
    numeric = [c for c in NUMERIC_COLUMNS + FE.ENGINEERED + list(extra_numeric) if c in rows.columns]

    def encoded() -> tuple[DataFrame, ...]:
        # a training part is read without the others
        parts = stored(SA.nested_folds(rows, k, inner_k, label, key, seed).withColumnRenamed("inner_fold", "_inner"), "training-parts", PART)
        return parts, *(stored(m, "encodings") for m in part_encodings(parts, label))

    # none of these reads another's result
    (parts, oof, frozen), medians, moments, codes = together(spark, [
        encoded, lambda: fold_medians(ranked_values(stored(fold_value_table(rows, numeric, k), "fold-values"), k), k),
        lambda: fold_moments(rows, numeric, k), lambda: stored(fold_codes(rows, k), "fold-codes")])
    sizes: dict = {"oof": {}, "frozen": {}, "codes": {}}
    counted = [oof.select(F.lit("oof").alias("kind"), PART, "col", F.lit(1).alias("n"), F.lit(None).cast("double").alias("mean")),
               frozen.select(F.lit("frozen").alias("kind"), PART, "col", F.lit(1).alias("n"), F.col("global_mean").alias("mean")),
               codes.select(F.lit("codes").alias("kind"), PART, "col", (F.octet_length("level") + 16).alias("n"), F.lit(None).cast("double").alias("mean"))]
    for r in (counted[0].unionByName(counted[1]).unionByName(counted[2]).groupBy("kind", PART, "col")
              .agg(F.sum("n").alias("n"), F.first("mean").alias("mean")).collect()):                  # a row per map, part and column
        sizes[r["kind"]][(r[PART], r["col"])] = (int(r["n"]), r["mean"])
    plans = {j: MO.FoldFeatures(numeric, medians[j], frozen.where(F.col(PART) == j).drop(PART),
                                codes.where((F.col(PART) == j) & F.col("seen")).drop(PART), moments[j]) for j in range(k)}
    for plan in plans.values():
        MO.name_columns(plan)
    return FoldPlans(k, rows, parts, plans, oof, frozen, codes, sizes)
