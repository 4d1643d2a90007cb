"""Sinks and artifacts (A3-A9): score files, versioned rewrites, fold
checkpoints with resume, model artifacts, parameter files and the run ledger.

All paths live under the shared checkpoint folder (``session.scratch_path``)
or a caller-given shared location; nothing is written to machine-local disk
on a cluster, and no path that is still being read lazily is overwritten.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.sources.tables import read_csv_typed


# ---- A3: scored-table sink ---------------------------------------------------------
def write_scores(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """(id, score) sink; CSV with header (or parquet)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def read_scores(spark: SparkSession, path: str, schema: str = "id long, score double") -> DataFrame:
    st = T._parse_datatype_string(schema)
    return read_csv_typed(spark, path, st)


# ---- A4: read - fix - write to a NEW version ---------------------------------------
def versioned_rewrite(spark: SparkSession, path: str, fix, schema: str = "id long, score double",
                      version: int = 2) -> str:
    """Read ``path``, apply ``fix(df)``, write ``{path}.v{version}`` (never the input path)."""
    out = f"{path.rstrip('/')}.v{version}"
    write_scores(fix(read_scores(spark, path, schema)), out)
    return out


def not_there(e: AnalysisException) -> bool:
    """Whether a read failed because nothing has been written yet, and for no other reason."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


# ---- A5: per-fold checkpoint with resume ---------------------------------------------
def write_fold_checkpoint(df: DataFrame, path: str, fold_col: str = "fold") -> None:
    """Partitioned by fold; dynamic overwrite replaces only the folds present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(fold_col).parquet(path))


def finished_folds(spark: SparkSession, path: str, fold_col: str = "fold") -> DataFrame:
    """Distinct fold ids already checkpointed (empty if nothing was written)."""
    try:
        return spark.read.parquet(path).select(fold_col).distinct()
    except AnalysisException as e:
        if not not_there(e):
            raise
        return spark.createDataFrame([], f"{fold_col} int")


def pending(df: DataFrame, done: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Resume: keep only rows of folds that are not checkpointed.  The finished
    folds (at most k values) are collected first, so the result can be written
    to the folder that ``done`` was read from."""
    finished = [r[0] for r in done.collect()]
    return df.where(~F.coalesce(F.col(fold_col).isin(finished), F.lit(False))) if finished else df


# ---- A6: pipeline artifacts ----------------------------------------------------------
def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


# ---- A7: parameter files: defaults (+) tuned overrides --------------------------------
def write_params(df: DataFrame, path: str) -> str:
    """(model, param, value) records as JSON lines."""
    df.write.mode("overwrite").json(path)
    return path


def merge_params(defaults: DataFrame, tuned: DataFrame) -> DataFrame:
    """Left join defaults with overrides on (model, param); tuned value wins."""
    t = tuned.select("model", "param", F.col("value").alias("_tuned"))
    return (defaults.join(t, ["model", "param"], "left")
            .select("model", "param", F.coalesce("_tuned", "value").alias("value"),
                    F.col("_tuned").isNotNull().alias("tuned")))


# ---- A8: experiment ledger -------------------------------------------------------------
LEDGER_SCHEMA = ("ts string, run_id string, n_splits int, features array<string>, auc double, "
                 "weights array<double>, seconds double")


def append_run_record(spark: SparkSession, path: str, run_id: str, n_splits: int, features,
                      auc: float, weights, seconds: float) -> None:
    ts = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rec = [(ts, run_id, int(n_splits), list(features), float(auc), [float(w) for w in weights], float(seconds))]
    spark.createDataFrame(rec, LEDGER_SCHEMA).coalesce(1).write.mode("append").json(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).json(path)
