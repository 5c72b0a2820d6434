"""From demand and weather to the feature and training tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions.time import with_calendar
from loadcast.operators import joins, quality, reshape, rolling, splits
from loadcast.operators.series import Series
from loadcast.session import materialise


def demand_features(demand: DataFrame, s: Series, target: bool = False) -> DataFrame:
    """Calendar, rolling and lag features of each hour with demand.

    The calendar is a projection of the event time, so it is computed after the window pass
    and never shuffled.
    """
    return with_calendar(rolling.add_rolling(demand, s, target=target), s.ts)


def assemble_features(demand: DataFrame, weather: DataFrame, s: Series, target: bool = False):
    """Features of all regions in one job: demand features joined to the hour's weather."""
    return joins.join_weather(demand_features(demand, s, target), weather)


def feature_view(features: DataFrame, weather: DataFrame, s: Series) -> DataFrame:
    """Stored demand features with the weather known at their time (point in time)."""
    return joins.asof_join(features, weather, s, "weather_")


def training_rows(view: DataFrame, s: Series) -> DataFrame:
    """Complete rows with the next-hour target.

    Incomplete rows go before ``forecast`` does, so a missing forecast removes a row although
    the model never sees it; each region loses its last row, which has no target.

    The view is written once: the target pass reads its input twice (chunk index and rows), and
    must not repeat the point-in-time join for it.
    """
    known = materialise(reshape.drop_for_training(view), "view")
    return quality.drop_incomplete(rolling.add_target(known, s))


def training_split(view: DataFrame, s: Series, test_size: float = 0.2) -> DataFrame:
    rows = training_rows(view, s).drop("forecast")
    whole = rows.withColumn("target", F.col("target").cast("bigint"))
    return splits.chrono_split(materialise(whole, "rows"), s, test_size)
