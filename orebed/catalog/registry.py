"""Registry of runnable queries and, where SQL can express them, their check."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a key, with its SQL equivalent if there is one."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Round doubles for comparison; adding zero removes a negative zero."""
    hit = set(cols)
    return df.select(*[
        (F.round(F.col(c).cast("double"), digits) + F.lit(0.0)).alias(c) if c in hit else F.col(c) for c in df.columns
    ])


def r6(expr: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0"
