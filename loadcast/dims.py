"""Constant dimensions.  All literals below are fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Region codes that may be requested (fixed values).
VALID_REGIONS = (
    "CAL", "CAR", "CENT", "FLA", "MIDA", "MIDW", "NE", "NW", "NY", "SE", "SW", "TEN", "TEX",
)

# Weather sampling points per region: city, latitude, longitude (fixed values).
REGION_CITIES = {
    "CAL": [
        ("Los Angeles", 34.05, -118.25),
        ("San Francisco", 37.77, -122.42),
        ("Sacramento", 38.58, -121.49),
        ("San Diego", 32.72, -117.16),
        ("Fresno", 36.74, -119.78),
    ],
    "CAR": [
        ("Charlotte", 35.23, -80.84),
        ("Columbia", 34.00, -81.03),
        ("Raleigh", 35.78, -78.64),
        ("Charleston", 32.78, -79.93),
        ("Greensboro", 36.07, -79.79),
    ],
    "CENT": [
        ("Little Rock", 34.74, -92.33),
        ("Baton Rouge", 30.45, -91.15),
        ("Des Moines", 41.60, -93.61),
        ("St. Louis", 38.63, -90.20),
        ("Omaha", 41.26, -95.94),
    ],
    "FLA": [
        ("Miami", 25.76, -80.19),
        ("Orlando", 28.54, -81.38),
        ("Tallahassee", 30.44, -84.28),
        ("Tampa", 27.95, -82.46),
        ("Jacksonville", 30.33, -81.65),
    ],
    "MIDW": [
        ("Chicago", 41.88, -87.63),
        ("Indianapolis", 39.77, -86.16),
        ("Minneapolis", 44.98, -93.27),
        ("Kansas City", 39.10, -94.58),
        ("Columbus", 39.96, -83.00),
        ("Milwaukee", 43.04, -87.91),
        ("Detroit", 42.33, -83.05),
    ],
    "NW": [
        ("Seattle", 47.61, -122.33),
        ("Portland", 45.52, -122.68),
        ("Boise", 43.62, -116.20),
        ("Spokane", 47.66, -117.43),
        ("Missoula", 46.87, -113.99),
    ],
    "NY": [
        ("New York City", 40.71, -74.01),
        ("Albany", 42.65, -73.75),
        ("Buffalo", 42.89, -78.87),
        ("Rochester", 43.16, -77.61),
        ("Syracuse", 43.04, -76.14),
    ],
    "SW": [
        ("Las Vegas", 36.17, -115.14),
        ("Phoenix", 33.45, -112.07),
        ("Denver", 39.74, -104.99),
        ("Salt Lake City", 40.76, -111.89),
        ("Albuquerque", 35.08, -106.65),
    ],
}

# Time zone in which a region's profiles are shown (fixed values).
REGION_ZONES = {
    "CAL": "America/Los_Angeles",
    "CAR": "America/New_York",
    "CENT": "America/Chicago",
    "FLA": "America/New_York",
    "MIDW": "America/Chicago",
    "NW": "America/Los_Angeles",
    "NY": "America/New_York",
    "SW": "America/Phoenix",
}

# States shown as part of a region (fixed values).
REGION_STATES = {
    "CAL": ["California"],
    "CAR": ["North Carolina", "South Carolina"],
    "CENT": ["Arkansas", "Louisiana", "Missouri", "Iowa"],
    "FLA": ["Florida"],
    "MIDW": [
        "Illinois", "Indiana", "Kansas", "Michigan", "Minnesota", "Nebraska",
        "North Dakota", "Ohio", "South Dakota", "Wisconsin",
    ],
    "NW": ["Idaho", "Montana", "Oregon", "Washington", "Wyoming"],
    "NY": ["New York"],
    "SW": ["Nevada", "Arizona", "New Mexico", "Colorado", "Utah"],
}


def valid_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r,) for r in VALID_REGIONS], "region string")


def region_cities(spark: SparkSession) -> DataFrame:
    rows = [(r, *city) for r, cities in REGION_CITIES.items() for city in cities]
    return spark.createDataFrame(
        rows, "region string, city string, latitude double, longitude double"
    )


def region_zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REGION_ZONES.items()), "region string, tz string")


def state_regions(spark: SparkSession) -> DataFrame:
    rows = [(s, r) for r, states in REGION_STATES.items() for s in states]
    return spark.createDataFrame(rows, "state string, region string")


def literal_lookup(pairs: dict[str, str], column):
    """A constant dimension as an expression: no join, no broadcast, works on streams."""
    entries = [F.lit(x) for pair in pairs.items() for x in pair]
    return F.create_map(*entries)[column]
