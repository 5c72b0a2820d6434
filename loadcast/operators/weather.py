"""City weather to regional weather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.functions.numbers import null_if_nan
from loadcast.functions.time import DAY_MS, floor_ms
from loadcast.schemas import WEATHER_MEASURES


def _mean(measure: str, skip_nulls: bool) -> Column:
    value = null_if_nan(F.col(measure).cast("double"))
    mean = F.avg(value)
    if not skip_nulls:
        mean = F.when(F.count(value) == F.count(F.lit(1)), mean)
    return mean.alias(measure)


def region_mean(
    cities: DataFrame, skip_nulls: bool = True, measures: tuple[str, ...] = WEATHER_MEASURES
) -> DataFrame:
    """Mean of each measure over the cities of a region and hour.

    With ``skip_nulls`` a missing city value is left out, without it the mean is missing
    too.  Partial sums combine before the shuffle.
    """
    means = [_mean(m, skip_nulls) for m in measures]
    return cities.groupBy("region", "timestamp_ms", "human_read_period").agg(*means)


def regional_history(cities: DataFrame, end_ms: Column) -> DataFrame:
    """The backfill variant: strict means up to midnight at the start of the end date."""
    kept = cities.filter(F.col("timestamp_ms") <= floor_ms(end_ms, DAY_MS))
    return region_mean(kept, skip_nulls=False)
