"""Chronological split and expanding time-series folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.operators.series import Series, blocked


def chrono_split(df: DataFrame, s: Series, test_size: float = 0.2) -> DataFrame:
    """Add ``split``: the first ``int(n * (1 - test_size))`` rows of each series train.

    The limit is a double product, floored, as binary rounding decides exact multiples.
    """
    numbered = blocked(df, s, lambda w: {}, numbered=True)
    limit = F.floor(F.col("_total").cast("double") * F.lit(1 - float(test_size)))
    split = F.when(F.col("_position") < limit, "train").otherwise("test")
    return numbered.withColumn("split", split).drop("_position", "_total")


def time_series_folds(df: DataFrame, s: Series, n_splits: int = 4) -> DataFrame:
    """Rows times folds: ``fold`` and ``role`` (``train`` or ``validate``).

    With n rows and k folds, validation parts of n div (k + 1) rows end the series one after
    the other; each fold trains on everything before its part.
    """
    numbered = blocked(df, s, lambda w: {}, numbered=True)
    part = F.expr(f"_total div {n_splits + 1}")
    start = F.col("_total") - (F.lit(n_splits) - F.col("fold")) * part
    position = F.col("_position")
    role = F.when(position < start, "train").when(position < start + part, "validate")
    return (
        numbered.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(n_splits)])))
        .withColumn("role", role)
        .filter(F.col("role").isNotNull())
        .drop("_position", "_total")
    )


def split_counts(split: DataFrame, key: str = "region") -> DataFrame:
    return split.groupBy(key, "split").agg(F.count(F.lit(1)).alias("n_rows"))
