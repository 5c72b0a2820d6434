"""Plain exports of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    """Part files with a header each; the write stays parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)
