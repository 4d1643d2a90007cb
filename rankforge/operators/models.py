"""Estimator presets over Spark ML (M1-M6, M9, M10) and the leak-free per-fold
feature plan that feeds them.

The original's three tree libraries are not available on Spark, so each
family maps to an MLlib learner with a preset chosen for diversity
(leaf-wise-like deep boosting, depth-wise boosting, bagged forest).  Trees in
MLlib have no missing-value branch (trap T8), so numerics are median-imputed
on the training part and NULL flags are added as features.

Fitting is distributed by MLlib (tree aggregation over partitions); the fold
loop is a short driver loop over k, as in any Spark cross-validation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (FMClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.operators import encode as EN
from rankforge.operators import features as FE
from rankforge.operators import sampling as SA
from rankforge.schema import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS
from rankforge.session import cut_lineage

FEATURES = "features"

# thousands of trees in a row: keep the rows' node ids and cut their lineage now and then
LONG_FIT = dict(cacheNodeIds=True, checkpointInterval=50)

# FIXED VALUES — preset hyper-parameters (full-size); tests and screening pass
# smaller ``max_iter`` through ``n_estimators``.
PRESETS = {
    "gbt_leafwise": dict(kind="gbt", maxIter=2500, stepSize=0.02, maxDepth=8, minInstancesPerNode=120,
                         subsamplingRate=0.85, featureSubsetStrategy="0.7", seed=42, **LONG_FIT),
    "gbt_depthwise": dict(kind="gbt", maxIter=2500, stepSize=0.02, maxDepth=6, minInstancesPerNode=10,
                          subsamplingRate=0.85, featureSubsetStrategy="0.65", seed=42, **LONG_FIT),
    "forest": dict(kind="rf", numTrees=300, maxDepth=10, minInstancesPerNode=20, subsamplingRate=0.8,
                   featureSubsetStrategy="sqrt", seed=42),
    "mlp": dict(kind="mlp", hidden=(128, 64), maxIter=100, seed=42),
    "fm": dict(kind="fm", factorSize=8, regParam=1e-4, initStd=0.01, maxIter=100, seed=42),
}


def estimator(name: str, label: str, n_features: int | None = None, n_estimators: int | None = None,
              features_col: str = FEATURES, overrides: dict | None = None,
              validation_col: str | None = None):
    """A configured Spark ML classifier for a preset name (M1-M5, M10 override, M6 early stop)."""
    p = dict(PRESETS[name])
    p.update(overrides or {})
    kind = p.pop("kind")
    common = dict(featuresCol=features_col, labelCol=label, predictionCol=f"pred_{name}")
    if kind == "gbt":
        if n_estimators is not None:
            p["maxIter"] = n_estimators
        est = GBTClassifier(**common, **p)
        if validation_col:
            est.setParams(validationIndicatorCol=validation_col, validationTol=0.0)
    elif kind == "rf":
        if n_estimators is not None:
            p["numTrees"] = n_estimators
        est = RandomForestClassifier(**common, **p)
    elif kind == "mlp":
        hidden = p.pop("hidden")
        if n_estimators is not None:
            p["maxIter"] = n_estimators
        est = MultilayerPerceptronClassifier(**common, layers=[n_features, *hidden, 2], **p)
    elif kind == "fm":
        if n_estimators is not None:
            p["maxIter"] = n_estimators
        est = FMClassifier(**common, **p)
    else:
        raise ValueError(name)
    return est.setProbabilityCol(f"prob_{name}").setRawPredictionCol(f"raw_{name}")


def positive_probability(name: str) -> Column:
    """P(y=1) from a fitted classifier's probability vector (JVM-side)."""
    return vector_to_array(F.col(f"prob_{name}"))[1]


def logistic_stacker(label: str, features_col: str, n_rows: int, c: float = 0.03) -> LogisticRegression:
    """M9: L2 logistic regression on Gauss ranks; sklearn's C maps to regParam = 1 / (C * n)."""
    return LogisticRegression(featuresCol=features_col, labelCol=label, regParam=1.0 / (c * max(n_rows, 1)),
                              elasticNetParam=0.0, standardization=False, maxIter=1000,
                              probabilityCol="prob_stack", rawPredictionCol="raw_stack",
                              predictionCol="pred_stack")


# ---------------------------------------------------------------------------------
# leak-free feature plan (fit on the training part of one fold)
# ---------------------------------------------------------------------------------
LEVEL_COLS = ["gender", "stress_level", "academic_work_impact", "gender_stress_level",
              "gender_academic_work_impact", "stress_level_academic_work_impact"]


@dataclass
class FoldFeatures:
    numeric: list[str]
    medians: dict
    te_global: DataFrame
    codes: DataFrame
    stats: dict                     # E11: mean and deviation of the zero-filled numerics
    feature_cols: list[str] = field(default_factory=list)
    neural_cols: list[str] = field(default_factory=list)

    def columns(self, family: str) -> list[str]:
        """Inputs of a family: median-filled for the trees, zero-filled and standardised for the neural ones."""
        return self.neural_cols if PRESETS[family]["kind"] in ("mlp", "fm") else self.feature_cols


def base_features(df: DataFrame) -> DataFrame:
    """Row-local features (F1-F16) and levels; safe to compute before the fold loop."""
    d = FE.engineer(df)
    return d.withColumns({f"lvl_{k}": v for k, v in EN.discrete_levels(d).items()})


def fit_fold_features(train: DataFrame, label: str, inner_k: int = 5, seed: int = 42,
                      extra_numeric=()) -> tuple[FoldFeatures, DataFrame]:
    """Fit encoders/imputers on ``train`` only; returns the plan and the encoded training rows.

    Training rows get out-of-fold target/frequency encoding over inner folds
    (S4); validation rows later get the frozen global map (E10).
    """
    # the training part is read by several statistics passes: store it, and cut the
    # small fitted maps too, so that later plans scan a written table.
    inner = cut_lineage(SA.stratified_folds(base_features(train), inner_k, label, seed=seed, out="_inner"))
    numeric = [c for c in NUMERIC_COLUMNS + FE.ENGINEERED + list(extra_numeric) if c in inner.columns]
    meds = {r["col"]: r["median"] for r in EN.exact_medians(inner, numeric).collect()}   # one per column
    lv = {c: F.col(f"lvl_{c}") for c in LEVEL_COLS}
    levels_only = [F.col(f"lvl_{c}").alias(c) for c in LEVEL_COLS]
    oof = EN.oof_encoding_map(inner.select(label, "_inner", *levels_only), LEVEL_COLS, label, "_inner")
    enc_train = EN.apply_oof_encoding(inner, oof, lv, "_inner").drop("_inner")
    te_global = cut_lineage(EN.target_encoding_map(inner.select(label, *levels_only), LEVEL_COLS, label))
    codes = cut_lineage(EN.label_code_map(inner, inner, CATEGORICAL_COLUMNS))
    plan = FoldFeatures(numeric, meds, te_global, codes, EN.zero_fill_stats(inner, numeric))
    return plan, finish(plan, enc_train, codes)


def transform_fold_features(plan: FoldFeatures, rows: DataFrame, engineered: bool = False) -> DataFrame:
    """New rows with a fold's encodings; ``engineered``: they have ``base_features`` already."""
    d = rows if engineered else base_features(rows)
    lv = {c: F.col(f"lvl_{c}") for c in LEVEL_COLS}
    enc = EN.apply_frozen_encoding(d, plan.te_global, lv)
    return finish(plan, enc, EN.extend_codes(plan.codes, rows, CATEGORICAL_COLUMNS))


def name_columns(plan: FoldFeatures) -> None:
    """Inputs of the tree and of the neural families, by name."""
    flags = [f"{c}_is_null" for c in plan.numeric]
    encoded = [f"{c}_{s}" for c in LEVEL_COLS for s in ("te", "freq")]
    plan.feature_cols = plan.numeric + flags + list(CATEGORICAL_COLUMNS) + encoded
    plan.neural_cols = [f"z_{c}" for c in plan.numeric] + flags + list(CATEGORICAL_COLUMNS) + encoded


def finish(plan: FoldFeatures, d: DataFrame, codes: DataFrame, code_sizes: dict | None = None) -> DataFrame:
    """Encoded rows with null flags, scaled and filled numerics and category codes."""
    scaled = {f"z_{c}": z for c, z in EN.standardized(plan.stats).items()}
    flags = {f"{c}_is_null": F.col(c).isNull().cast("double") for c in plan.numeric}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(plan.medians.get(c) or 0.0)))
              for c in plan.numeric}
    d = d.withColumns(flags).withColumns(scaled).withColumns(filled)
    d = EN.apply_codes(d, codes, CATEGORICAL_COLUMNS, token="Missing", sizes=code_sizes)
    d = d.withColumns({c: F.col(c).cast("double") for c in CATEGORICAL_COLUMNS})
    name_columns(plan)
    return d


def assemble(df: DataFrame, cols: list[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def vector_of(family: str) -> str:
    """The vector column that a family reads: the trees share one, the neural families another."""
    return "features_neural" if PRESETS[family]["kind"] in ("mlp", "fm") else "features_tree"


def vector_columns(plan: FoldFeatures, families) -> dict[str, list[str]]:
    return {vector_of(n): plan.columns(n) for n in families}


def assemble_all(df: DataFrame, vectors: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """``keep`` and a vector column for each entry of ``vectors``."""
    for out, cols in vectors.items():
        df = assemble(df, cols, out)
    return df.select(*keep, *vectors)


def fit_family(name: str, train: DataFrame, label: str, cols: list[str], n_estimators: int | None = None,
               validation_col: str | None = None, overrides: dict | None = None, vector: str | None = None) -> PipelineModel:
    """Assemble + classifier, fitted as one Pipeline; ``vector``: where ``train`` has ``cols`` put together already."""
    assembler = VectorAssembler(inputCols=cols, outputCol=vector or FEATURES, handleInvalid="keep")
    classifier = estimator(name, label, len(cols), n_estimators, vector or FEATURES, overrides, validation_col)
    return PipelineModel([assembler, classifier.fit(train if vector else assembler.transform(train))])


def score_family(model: PipelineModel, name: str, rows: DataFrame, out: str) -> DataFrame:
    keep = [c for c in rows.columns]
    scored = model.transform(rows)
    return scored.select(*keep, positive_probability(name).alias(out))


def score_vector(model: PipelineModel, name: str, rows: DataFrame, out: str) -> DataFrame:
    """As ``score_family`` for rows that have the family's vector already."""
    classifier = model.stages[-1]
    read = {classifier.getFeaturesCol(): F.col(vector_of(name))}
    return (classifier.transform(rows.withColumns(read)).select(*rows.columns, positive_probability(name).alias(out)))
