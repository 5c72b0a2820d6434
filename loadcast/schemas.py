"""Explicit schemas of the records that cross a job boundary."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw metric types and the wide columns they become (fixed values).
METRICS = {"D": "demand", "DF": "forecast", "TI": "ti", "NG": "ng"}

# Column names used on the scoring side for the same metrics (fixed values).
SCORING_ALIASES = {
    "forecast": "demand_forecast",
    "ti": "total_interchange",
    "ng": "net_generation",
}

# Weather payload field -> regional weather column (fixed values).
WEATHER_FIELDS = {
    "temperature_2m": "temperature",
    "apparent_temperature": "apparent_temperature",
    "dew_point_2m": "dew_point",
    "wind_speed_10m": "wind_speed",
    "relative_humidity_2m": "humidity",
    "shortwave_radiation": "solar_radiation",
    "direct_radiation": "direct_radiation",
    "diffuse_radiation": "diffuse_radiation",
    "precipitation": "precipitation",
    "snowfall": "snowfall",
    "surface_pressure": "surface_pressure",
}
OPTIONAL_WEATHER_FIELDS = ("shortwave_radiation", "direct_radiation", "diffuse_radiation")
WEATHER_MEASURES = tuple(WEATHER_FIELDS.values())

ROLLING_WINDOWS = (3, 24, 168)
LAGS = (1, 24, 168)
ROLLING_COLUMNS = (
    *(f"{stat}_{n}" for n in ROLLING_WINDOWS for stat in ("mean", "median")),
    *(f"lag_{n}h" for n in LAGS),
)
CALENDAR_COLUMNS = (
    "hour_category",
    "hour_category_num",
    "is_holiday",
    "hour_sin",
    "hour_cos",
    "day_of_week_sin",
    "day_of_week_cos",
    "month_sin",
    "month_cos",
)

DEMAND_PAYLOAD = T.StructType().add(
    "response",
    T.StructType().add(
        "data",
        T.ArrayType(
            T.StructType()
            .add("period", "string")
            .add("respondent", "string")
            .add("type", "string")
            .add("value", "string")
        ),
    ),
)

DEMAND_RECORD = (
    T.StructType()
    .add("timestamp_ms", "long")
    .add("human_read_period", "string")
    .add("region", "string")
    .add("demand", "long")
    .add("forecast", "long")
    .add("ti", "long")
    .add("ng", "long")
)


def _hourly_arrays() -> T.StructType:
    hourly = T.StructType().add("time", T.ArrayType(T.StringType()))
    for field in WEATHER_FIELDS:
        hourly = hourly.add(field, T.ArrayType(T.DoubleType()))
    return hourly


WEATHER_PAYLOAD = (
    T.StructType()
    .add("status", "integer")
    .add("region", "string")
    .add("city", "string")
    .add("latitude", "double")
    .add("longitude", "double")
    .add("hourly", _hourly_arrays())
)


def _weather_record() -> T.StructType:
    record = (
        T.StructType()
        .add("region", "string")
        .add("timestamp_ms", "long")
        .add("human_read_period", "string")
    )
    for measure in WEATHER_MEASURES:
        record = record.add(measure, "double")
    return record


WEATHER_RECORD = _weather_record()

# ``offset`` is the place of a message among those that were written with it.
TOPIC_MESSAGE = T.StructType().add("key", "string").add("value", "string").add("offset", "long")

GEO_COLLECTION = T.StructType().add(
    "features",
    T.ArrayType(
        T.StructType()
        .add("type", "string")
        .add(
            "geometry",
            # Coordinates nest to a depth that depends on the geometry; kept as JSON text.
            T.StructType().add("type", "string").add("coordinates", "string"),
        )
        .add("properties", T.StructType().add("NAME", "string"))
    ),
)

REGISTRY_RECORD = (
    T.StructType()
    .add("name", "string")
    .add("region", "string")
    .add("is_tuned", "boolean")
    .add(
        "versions",
        T.ArrayType(
            T.StructType()
            .add("version", "string")
            .add("status", "string")
            .add("experiment_key", "string")
        ),
    )
)


def with_rolling(schema: T.StructType) -> T.StructType:
    out = T.StructType(list(schema.fields))
    for name in ROLLING_COLUMNS:
        out = out.add(name, "double")
    return out
