"""Landed JSON payload files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.functions.time import parse_minute_period
from loadcast.operators.joins import lookup
from loadcast.schemas import (
    DEMAND_PAYLOAD,
    GEO_COLLECTION,
    OPTIONAL_WEATHER_FIELDS,
    WEATHER_FIELDS,
    WEATHER_PAYLOAD,
)
from loadcast.sources.topics import file_arrival


def read_demand_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw demand rows of payload files (one document per line, or per file)."""
    return explode_demand(spark.read.schema(DEMAND_PAYLOAD).json(path, multiLine=multi_line))


def explode_demand(payloads: DataFrame) -> DataFrame:
    return payloads.select(F.inline("response.data"))


def explode_in_order(payloads: DataFrame) -> DataFrame:
    """The same of landed files, with ``seq``: text that sorts rows by arrival.

    Order is file time, file, and place in the payload.
    """
    placed = payloads.select(F.posexplode("response.data").alias("_at", "_row"), "_metadata")
    return placed.select("_row.*", file_arrival(F.col("_at")).alias("seq"))


def demand_from_text(text: DataFrame, column: str = "value") -> DataFrame:
    """The same rows from payloads held as JSON text in a column."""
    return explode_demand(text.select(F.from_json(column, DEMAND_PAYLOAD).alias("_p")).select("_p.*"))


def read_weather_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return explode_weather(spark.read.schema(WEATHER_PAYLOAD).json(path, multiLine=multi_line))


def successful(payloads: DataFrame) -> DataFrame:
    return payloads.filter(F.col("status") == 200)


def or_missing(values: Column, times: Column) -> Column:
    """An absent array as one of NULLs: zipping with a NULL array would lose all rows."""
    return F.coalesce(values, F.array_repeat(F.lit(None).cast("double"), F.size(times)))


def explode_weather(payloads: DataFrame) -> DataFrame:
    """Parallel arrays to one row per city and hour; failed payloads are left out."""
    times = F.col("hourly.time")
    arrays = [times.alias("time")]
    for field in WEATHER_FIELDS:
        values = F.col(f"hourly.{field}")
        if field in OPTIONAL_WEATHER_FIELDS:
            values = or_missing(values, times)
        arrays.append(values.alias(field))
    kept = successful(payloads).filter(times.isNotNull())
    rows = kept.select("region", "city", F.inline(F.arrays_zip(*arrays)))
    return rows.select(
        "region",
        "city",
        parse_minute_period("time").alias("timestamp_ms"),
        F.col("time").alias("human_read_period"),
        *[F.col(field).alias(name) for field, name in WEATHER_FIELDS.items()],
    )


def read_state_shapes(spark: SparkSession, path: str, states: DataFrame) -> DataFrame:
    """Features of a state collection that belong to a region, with the region attached."""
    collection = spark.read.schema(GEO_COLLECTION).json(path, multiLine=True)
    shapes = collection.select(F.inline("features")).withColumn("state", F.col("properties.NAME"))
    return lookup(shapes, states, "state").select(
        "type",
        "geometry",
        F.struct(F.col("state").alias("NAME"), F.col("region")).alias("properties"),
        F.col("state").alias("NAME"),
        "region",
    )
