"""Fold manifest (A5, C7): a commit record per fold, written after its data.

A fold's rows go to the fold-partitioned checkpoint first; its record - rows,
classes, AUC of the blend, seconds - is appended to a table beside it only
then.  A fold whose data are there without a record was cut off and is computed
again.  A fold that was committed twice (a retry) counts once, by its newest
record; records of other runs in the same table do not count.

A NULL label or score takes no part in the AUC; a fold of one class has none.
"""

from __future__ import annotations

import time
from contextlib import AbstractContextManager, nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.operators.metrics import auc_by
from rankforge.sources.sinks import not_there

COMMIT_SCHEMA = "run_id string, fold int, n_rows long, n_pos long, n_neg long, auc double, seconds double, attempt long"


def manifest_path(checkpoint: str) -> str:
    """The table of commit records that belongs to a checkpoint."""
    return f"{checkpoint.rstrip('/')}.commits"


def commit_fold(rows: DataFrame, path: str, run_id: str, fold: int, score: str, label: str, seconds: float,
                alone: AbstractContextManager = nullcontext()) -> None:
    """Append the record of ``fold``; ``rows`` are its stored rows, read back.  ``alone`` is held
    for the append alone, as folds side by side may not write one table at a time."""
    spark = rows.sparkSession
    auc = auc_by(rows, score, label).first()
    n_pos, n_neg, value = (auc["n_pos"], auc["n_neg"], auc["auc"]) if auc else (0, 0, None)
    record = (run_id, int(fold), rows.count(), int(n_pos or 0), int(n_neg or 0), value, float(seconds), time.time_ns())
    with alone:
        spark.createDataFrame([record], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def committed(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The newest record of every fold of a run (no rows if nothing was committed)."""
    try:
        records = spark.read.schema(COMMIT_SCHEMA).parquet(path)
    except AnalysisException as e:
        if not not_there(e):
            raise
        names = [c.split() for c in COMMIT_SCHEMA.split(", ")]
        records = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in names])   # no Python worker starts
    rest = ["n_rows", "n_pos", "n_neg", "auc", "seconds"]
    newest = F.max_by(F.struct(*rest), "attempt").alias("_r")
    return records.where(F.col("run_id") == run_id).groupBy("fold").agg(newest).select("fold", *[f"_r.{c}" for c in rest])


def progress(commits: DataFrame, n_folds: int) -> DataFrame:
    """Folds done and left, rows scored, mean AUC and seconds, and the time left at that pace."""
    out = commits.agg(F.count(F.lit(1)).cast("int").alias("folds_done"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows_scored"),
                      F.avg("auc").alias("mean_auc"), F.avg("seconds").alias("mean_seconds"))
    left = F.lit(n_folds) - F.col("folds_done")
    return out.withColumns({"folds_left": left, "eta_seconds": left * F.col("mean_seconds")})
