"""Registration of queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

DIGITS = 6


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query.  Doubles are rounded, so that the order of a sum does not matter."""

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(use_utc(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return run

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Round double columns; adding 0.0 turns a negative zero into zero."""
    columns = {
        c: F.round(F.col(c), DIGITS) + F.lit(0.0) for c, kind in df.dtypes if kind == "double"
    }
    return df.withColumns(columns) if columns else df


def r(expression: str, name: str | None = None) -> str:
    """SQL twin of ``rounded`` for one column."""
    return f"round(CAST({expression} AS DOUBLE), {DIGITS}) + 0.0 AS {name or expression}"


def rs(*names: str) -> str:
    return ", ".join(r(n) for n in names)
