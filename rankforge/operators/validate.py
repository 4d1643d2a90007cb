"""Projection, schema and validation operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.schema import BOUNDS


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """B1: drop, ignoring absent names (``DataFrame.drop`` already ignores them)."""
    return df.drop(*[c for c in cols if c in df.columns])


def coerce_numeric(df: DataFrame, cols, dtype: str = "double") -> DataFrame:
    """B2: unparsable -> NULL (``try_cast``); absent column -> all-NULL column."""
    return df.withColumns({c: (F.col(c).try_cast(dtype) if c in df.columns else F.lit(None).cast(dtype))
                           for c in cols})


def zero_fill(c: str | Column) -> Column:
    """``coalesce(c, 0.0)`` inside an expression."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0.0))


def violations(df: DataFrame, bounds: dict | None = None) -> Column:
    """Array of ``'<col> out of [lo, hi]'`` messages; NULL values pass."""
    bounds = bounds or BOUNDS
    msgs = []
    for c, (lo, hi) in bounds.items():
        if c not in df.columns:
            continue
        v = F.col(c)
        bad = None
        if lo is not None:
            bad = v < F.lit(float(lo))
        if hi is not None:
            hb = v > F.lit(float(hi))
            bad = hb if bad is None else (bad | hb)
        text = f"{c} out of [{lo}, {hi if hi is not None else 'inf'}]"
        msgs.append(F.when(bad, F.lit(text)))
    return F.array_compact(F.array(*msgs)) if msgs else F.array().cast("array<string>")


def validate_rows(df: DataFrame, bounds: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their ``violations``) — one projection, two filters."""
    tagged = df.withColumn("violations", violations(df, bounds))
    return (tagged.where(F.size("violations") == 0).drop("violations"),
            tagged.where(F.size("violations") > 0))


def downcast(df: DataFrame) -> DataFrame:
    """Doubles -> float; integers -> the smallest type that holds the observed range.

    One min/max aggregate over all integer columns decides each target type.
    """
    ints = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType))]
    target = {}
    if ints:
        row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in ints],
                     *[F.max(c).alias(f"hi_{c}") for c in ints]).first()
        for c in ints:
            lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
            if lo is None:
                target[c] = "byte"
            elif -128 <= lo and hi <= 127:
                target[c] = "byte"
            elif -32768 <= lo and hi <= 32767:
                target[c] = "short"
            elif -2 ** 31 <= lo and hi < 2 ** 31:
                target[c] = "int"
            else:
                target[c] = "long"
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            out.append(F.col(f.name).cast("float").alias(f.name))
        elif f.name in target:
            out.append(F.col(f.name).cast(target[f.name]).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns (schema walk on the driver)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude=()) -> list[str]:
    """Non-numeric columns."""
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def find_target(df: DataFrame, patterns=("label", "target", "addicted")) -> str | None:
    """First column whose name matches a target pattern."""
    for c in df.columns:
        if any(re.search(p, c, re.IGNORECASE) for p in patterns):
            return c
    return None


def first_non_id(df: DataFrame, id_col: str = "id") -> str:
    """The first column that is not the id (score-file convention)."""
    return [c for c in df.columns if c != id_col][0]


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Fail before any job is planned when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
