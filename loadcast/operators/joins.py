"""Joins: point-in-time, exact hour, prediction assembly and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions.time import HOUR_MS
from loadcast.operators.reshape import prefix_columns
from loadcast.operators.series import Series, carried


def asof_join(
    left: DataFrame,
    right: DataFrame,
    s: Series,
    prefix: str,
    tolerance_ms: int | None = None,
) -> DataFrame:
    """Left join each row to the latest right row of its key at or before its event time.

    Both sides become one tagged series whose running state is the last right row, so the
    work is linear in the rows, a right row at the same time counts, and a hot key spreads
    over its chunks.  Right columns, key and time included, get ``prefix``.
    """
    right = prefix_columns(right, prefix, [])
    right_row = F.struct(*[F.col(c) for c in right.columns])
    tagged = (
        left.select(s.key, s.ts, F.lit(1).alias("_from"), F.struct(*left.columns).alias("_left"))
    ).unionByName(
        right.select(
            F.col(f"{prefix}{s.key}").alias(s.key),
            F.col(f"{prefix}{s.ts}").alias(s.ts),
            F.lit(0).alias("_from"),
            right_row.alias("_right"),
        ),
        allowMissingColumns=True,
    )

    def last_right(state: Column, is_carry: Column, w) -> Column:
        return F.last(state, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))

    matched = carried(
        tagged, s, F.col("_right"), "_match", before=last_right, order=[F.col("_from")]
    ).filter(F.col("_from") == 1)
    match = F.col("_match")
    if tolerance_ms is not None:
        age = F.col(s.ts) - match[f"{prefix}{s.ts}"]
        match = F.when(age <= tolerance_ms, match)
    return matched.select("_left.*", match.alias("_match")).select(
        *left.columns, *[F.col("_match")[c].alias(c) for c in right.columns]
    )


def join_weather(features: DataFrame, weather: DataFrame) -> DataFrame:
    """Exact-hour left join; weather measures get the ``weather_`` prefix."""
    keys = ["region", "timestamp_ms"]
    return features.join(
        prefix_columns(weather.drop("human_read_period"), "weather_", keys), keys, "left"
    )


def shift_predictions(scored: DataFrame, *keep: str) -> DataFrame:
    """A prediction made at an hour is about the next hour."""
    return scored.select(
        "region", (F.col("timestamp_ms") + HOUR_MS).alias("timestamp_ms"), "prediction", *keep
    )


def assemble_predictions(
    scored: DataFrame, forecast: DataFrame, features: DataFrame
) -> DataFrame:
    """Prediction with the forecast and the features of the hour it is about.

    Both joins use the same keys, so the second one reuses the partitioning of the first.
    """
    keys = ["region", "timestamp_ms"]
    return shift_predictions(scored).join(forecast, keys, "left").join(features, keys, "left")


def debug_predictions(actual: DataFrame, scored: DataFrame) -> DataFrame:
    """Actual, forecast and prediction per hour, plus each region's still open next hour.

    Every hour is shifted, so the last prediction is the one without an actual row; it is
    appended with NULL actual and forecast, one hour after the last matched row.
    """
    keys = ["region", "timestamp_ms"]
    matched = actual.select(*keys, "demand", "forecast").join(shift_predictions(scored), keys)
    end = matched.groupBy("region").agg(F.max("timestamp_ms").alias("_end"))
    newest = scored.groupBy("region").agg(F.max_by("prediction", "timestamp_ms").alias("prediction"))
    future = end.join(newest, "region").select(
        "region",
        (F.col("_end") + HOUR_MS).alias("timestamp_ms"),
        F.lit(None).cast(matched.schema["demand"].dataType).alias("demand"),
        F.lit(None).cast(matched.schema["forecast"].dataType).alias("forecast"),
        "prediction",
    )
    return matched.unionByName(future)


def lookup(fact: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Dimension lookup; the planner broadcasts by measured size and shuffles beyond it."""
    return fact.join(dimension, key, how)
