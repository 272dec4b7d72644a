"""Where queries and their check SQL meet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, sf_dir)``; ``sql`` computes the same rows from the same tables."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def r(value, n: int = 6) -> Column:
    """Rounded for comparison: a nudge keeps exact decimal ties on one side in both engines, no zero is negative."""
    c = F.col(value) if isinstance(value, str) else value
    return F.round(c + F.lit(10.0 ** -(n + 3)), n) + F.lit(0.0)


def rounded(df: DataFrame, *names: str, n: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, n) for c in names})


def plain_time(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without zone, as the tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


def sr(expression: str, n: int = 6) -> str:
    """SQL twin of ``r``."""
    return f"(round(({expression}) + 1e-{n + 3}, {n}) + 0.0)"
