"""Query registry shared by the catalog modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register a query (and its DuckDB oracle, if SQL-expressible)."""
    def deco(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = half_up_rounding(sql)
        return fn
    return deco


def half_up_rounding(sql: str) -> str:
    """Rewrite ``round(x, d)`` as ``floor(x * 10^d + 0.5) / 10^d`` — the same
    IEEE steps the Spark side uses (``functions.columns.rnd``)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 0, j + 6, None
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                last_comma = k
            k += 1
        if last_comma is None:
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        inner = half_up_rounding(sql[j + 6:last_comma])
        digits = int(sql[last_comma + 1:k].strip())
        scale = f"{float(10 ** digits)!r}e0" if "e" not in repr(float(10 ** digits)) else repr(float(10 ** digits))
        out.append(sql[i:j])
        out.append(f"(floor(({inner}) * {scale} + 0.5e0) / {scale})")
        i = k + 1


def D(x) -> str:
    """CAST(x AS DOUBLE) — DuckDB reads plain decimals as DECIMAL (trap T9)."""
    return f"CAST({x} AS DOUBLE)"


def r6(expr: str) -> str:
    return f"round({expr}, 6)"
