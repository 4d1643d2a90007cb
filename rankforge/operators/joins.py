"""Equi-joins in which NULL is a value like any other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                   broadcast: bool = False) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the result has each key once.

    Strata, groups and classes may be NULL, and an ordinary equi-join would drop
    their rows.  ``broadcast`` is for a right side of a proven size.
    """
    named = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(F.broadcast(named) if broadcast else named, on, how).drop(*[f"_right_{k}" for k in keys])
