"""Tables behind the demand profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions.time import local_columns
from loadcast.operators.reshape import labelled


def with_local_time(df: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Add the regional wall clock and its fields; ``df`` has ``tz`` or ``zones`` supplies it.

    A region without a zone fails, as its local hour would be wrong, not missing.
    """
    if zones is not None:
        df = df.join(zones, "region", "left")
    known = F.when(F.col("tz").isNotNull(), F.col("tz")).otherwise(
        F.raise_error(F.concat(F.lit("no time zone for region "), "region")).cast("string")
    )
    return df.withColumns(local_columns("timestamp_ms", known))


def hourly_profile(df: DataFrame, demand: str = "demand", temperature: str = "weather_temperature"):
    return df.groupBy("region", "hour").agg(
        F.avg(demand).alias("avg_demand"), F.avg(temperature).alias("avg_temperature")
    )


def weekend_profile(df: DataFrame, demand: str = "demand") -> DataFrame:
    day_type = labelled(F.col("is_weekend"), {0: "Weekday", 1: "Weekend"})
    grouped = df.groupBy("region", "hour", "is_weekend").agg(F.avg(demand).alias("avg_demand"))
    return grouped.withColumn("day_type", day_type)


def axis_bounds(df: DataFrame, keys: list[str], columns: list[str], margin: float) -> DataFrame:
    """Smallest and largest value over several columns, widened by ``margin``."""
    lows = [F.min(F.col(c).cast("double")) for c in columns]
    highs = [F.max(F.col(c).cast("double")) for c in columns]
    low = F.least(*lows) if len(lows) > 1 else lows[0]
    high = F.greatest(*highs) if len(highs) > 1 else highs[0]
    return df.groupBy(*keys).agg(
        (low - margin).alias("axis_min"), (high + margin).alias("axis_max")
    )


def counts_rollup(df: DataFrame, key: str = "region") -> DataFrame:
    """Rows per key and the grand total (NULL key)."""
    return df.rollup(key).agg(F.count(F.lit(1)).alias("n_rows"))


def time_extent(df: DataFrame, key: str = "region", ts: str = "timestamp_ms") -> DataFrame:
    return df.groupBy(key).agg(F.min(ts).alias("first_ms"), F.max(ts).alias("last_ms"))
