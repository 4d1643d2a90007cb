"""Table scans (A1, A2) and ingest hygiene.

Parquet is the default format; CSV is read with an explicit schema (no
inference pass over the data) and dirty numerics are coerced with
``try_cast`` so one bad cell does not fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Trap T1: NULL is the only missing marker; NaN becomes NULL at ingest."""
    doubles = {f.name for f in df.schema.fields
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or list(doubles)) if c in doubles]
    if not targets:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in targets})


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   numeric_cols: list[str] | None = None) -> DataFrame:
    """A1: header CSV with a declared schema.

    Numeric columns are read as strings first and coerced with ``try_cast``
    (unparsable -> NULL) so a dirty file degrades to missing values instead of
    failing or silently dropping rows (PERMISSIVE mode would null the row).
    """
    numeric = set(numeric_cols if numeric_cols is not None else
                  [f.name for f in schema.fields
                   if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.IntegerType,
                                              T.LongType, T.ShortType, T.ByteType))])
    raw_schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in numeric else f.dataType, True)
        for f in schema.fields
    ])
    raw = spark.read.schema(raw_schema).option("header", True).csv(path)
    out = raw.select([
        (F.col(f.name).try_cast(f.dataType) if f.name in numeric else F.col(f.name)).alias(f.name)
        for f in schema.fields
    ])
    return nan_to_null(out)


def first_n(df: DataFrame, n: int, order_col: str = "id") -> DataFrame:
    """A2: the first ``n`` rows by key (file order is not a Spark concept).

    Planned as TakeOrderedAndProject: each task keeps its own top-n, so only
    n x partitions rows ever reach the final merge.
    """
    return df.orderBy(F.col(order_col).asc()).limit(n)


def col_or_null(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """B2: numeric coercion; an absent column becomes all-NULL."""
    if name in df.columns:
        return F.col(name).try_cast(dtype)
    return F.lit(None).cast(dtype)
