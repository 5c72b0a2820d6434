"""Logical tables of the domain, derived from whole star-schema tables.

``events`` stands in for demand and weather readings, ``orders`` for a long calendar,
``part`` for a model registry.  Each Spark builder has a SQL twin (a common table expression)
for the side-by-side check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast import dims
from loadcast.functions.time import HOUR_MS, floor_ms, format_period
from loadcast.operators import evaluate, joins, quality, reshape, rolling, weather
from loadcast.operators.series import Series
from loadcast.session import materialise

SERIES = Series()

# Time zone per stand-in region.
EVENT_ZONES = {
    "view": "America/Los_Angeles",
    "click": "America/New_York",
    "error": "America/Chicago",
    "signup": "America/Phoenix",
    "purchase": "America/New_York",
}
PRIORITY_ZONES = {
    "1-URGENT": "America/Los_Angeles",
    "2-HIGH": "America/New_York",
    "3-MEDIUM": "America/Chicago",
    "4-NOT SPECIFIED": "America/Phoenix",
    "5-LOW": "America/New_York",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ms(c: str) -> Column:
    return F.unix_millis(F.col(c).cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ms", _ms("ts"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(region, timestamp_ms, demand): whole-number demand per hour, with natural gaps."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    return (
        events(spark, sf_dir)
        .groupBy(
            F.col("event_type").alias("region"), floor_ms("ms", HOUR_MS).alias("timestamp_ms")
        )
        .agg(F.sum(cents).alias("demand"))
    )


def hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly rows as a table, for operators that read their input twice.

    They are small next to the events, which are then read only once.
    """
    return materialise(hourly(spark, sf_dir), "hourly")


HOURLY = """hourly AS (
  SELECT event_type AS region, (epoch_ms(ts) // 3600000) * 3600000 AS timestamp_ms,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS demand
  FROM events GROUP BY 1, 2)"""


def events_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in their properties, taken from the JSON once per row."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events(spark, sf_dir).withColumn("k", k)


def raw_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows: period, respondent, type (one unknown), value (some no number), seq."""
    k = F.col("k")
    kind = (
        F.when(k < 30, "D").when(k < 55, "DF").when(k < 75, "TI").when(k < 95, "NG").otherwise("XX")
    )
    text = F.when(
        F.col("value") <= 200, F.round(F.col("value") * 100).cast("bigint").cast("string")
    ).otherwise("n/a")
    return events_with_k(spark, sf_dir).select(
        format_period("ms").alias("period"),
        F.col("event_type").alias("respondent"),
        kind.alias("type"),
        text.alias("value"),
        F.col("event_id").alias("seq"),
    )


RAW = """raw AS (
  SELECT strftime(ts, '%Y-%m-%dT%H') AS period, event_type AS respondent,
         CASE WHEN k < 30 THEN 'D' WHEN k < 55 THEN 'DF' WHEN k < 75 THEN 'TI'
              WHEN k < 95 THEN 'NG' ELSE 'XX' END AS type,
         CASE WHEN value <= 200
              THEN CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) ELSE 'n/a' END AS value,
         event_id AS seq
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

TYPED = RAW + """, typed AS (
  SELECT epoch_ms(strptime(period, '%Y-%m-%dT%H')) AS timestamp_ms,
         period AS human_read_period, respondent AS region,
         TRY_CAST(value AS BIGINT) AS electricity_demand, type AS electricity_demand_type, seq
  FROM raw)"""

MERGED = TYPED + """, merged AS (
  SELECT timestamp_ms, min(human_read_period) AS human_read_period, region,
         arg_max_null(electricity_demand, seq)
           FILTER (WHERE electricity_demand_type = 'D') AS demand,
         arg_max_null(electricity_demand, seq)
           FILTER (WHERE electricity_demand_type = 'DF') AS forecast,
         arg_max_null(electricity_demand, seq)
           FILTER (WHERE electricity_demand_type = 'TI') AS ti,
         arg_max_null(electricity_demand, seq)
           FILTER (WHERE electricity_demand_type = 'NG') AS ng
  FROM typed WHERE electricity_demand_type IN ('D', 'DF', 'TI', 'NG')
  GROUP BY timestamp_ms, region)"""


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.typed_records(raw_long(spark, sf_dir), "seq")


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.merge_metrics(typed(spark, sf_dir), "seq")


def merged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged rows as a table, for operators that read their input more than once.

    They are small next to the raw rows, which are then read and parsed only once.
    """
    return materialise(merged(spark, sf_dir), "merged")


def city_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per city and hour with missing values where a reading is out of range."""
    # Whole numbers, so that sums are exact in any order of the rows.
    k, value = F.col("k").cast("double"), F.round(F.col("value") * 100)
    measures = {
        "temperature": value,
        "apparent_temperature": value - 200,
        "dew_point": value * 2,
        "wind_speed": k + 3,
        "humidity": k,
        "solar_radiation": F.when(value <= 10000, value),
        "direct_radiation": F.when(k != 0, k * 3),
        "diffuse_radiation": F.when(value >= 100, value * 4),
        "precipitation": k * 5,
        "snowfall": F.when(k > 90, 1.0).otherwise(0.0),
        "surface_pressure": value + 100000,
    }
    ms = floor_ms("ms", HOUR_MS)
    return events_with_k(spark, sf_dir).select(
        F.col("event_type").alias("region"),
        F.col("user_id").cast("string").alias("city"),
        ms.alias("timestamp_ms"),
        format_period(ms, "yyyy-MM-dd'T'HH:mm").alias("human_read_period"),
        *[c.cast("double").alias(name) for name, c in measures.items()],
    )


CITY_WEATHER = """city_weather AS (
  SELECT event_type AS region, CAST(user_id AS VARCHAR) AS city,
         (epoch_ms(ts) // 3600000) * 3600000 AS timestamp_ms,
         strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') AS human_read_period,
         v AS temperature, v - 200 AS apparent_temperature, v * 2 AS dew_point,
         k + 3 AS wind_speed, k AS humidity,
         CASE WHEN v <= 10000 THEN v END AS solar_radiation,
         CASE WHEN k <> 0 THEN k * 3 END AS direct_radiation,
         CASE WHEN v >= 100 THEN v * 4 END AS diffuse_radiation,
         k * 5 AS precipitation, CASE WHEN k > 90 THEN 1.0 ELSE 0.0 END AS snowfall,
         v + 100000 AS surface_pressure
  FROM (SELECT *, round(value * 100) AS v,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events))"""


def regional_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.region_mean(city_weather(spark, sf_dir))


_MEANS = ", ".join(f"avg({m}) AS {m}" for m in weather.WEATHER_MEASURES)
WEATHER = CITY_WEATHER + f""", weather AS (
  SELECT region, timestamp_ms, min(human_read_period) AS human_read_period, {_MEANS}
  FROM city_weather GROUP BY region, timestamp_ms)"""


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order times over seven years, holidays and clock changes included."""
    orders = table(spark, sf_dir, "orders")
    ms = _ms("o_orderdate") + F.pmod("o_orderkey", F.lit(24)) * HOUR_MS
    return orders.select("o_orderkey", "o_orderpriority", ms.alias("timestamp_ms"))


CALENDAR = """calendar AS (
  SELECT o_orderkey, o_orderpriority,
         epoch_ms(o_orderdate) + (o_orderkey % 24) * 3600000 AS timestamp_ms,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS t
  FROM orders)"""


def rolled(spark: SparkSession, sf_dir: str, target: bool = False) -> DataFrame:
    return rolling.add_rolling(hourly(spark, sf_dir), SERIES, target=target)


_FULL = "CASE WHEN count(demand) OVER w{n} >= {n} THEN {f}(demand) OVER w{n} END AS {name}_{n}"
ROLL_COLUMNS = ",\n         ".join(
    [_FULL.format(n=n, f="avg", name="mean") for n in (3, 24, 168)]
    + [_FULL.format(n=n, f="median", name="median") for n in (3, 24, 168)]
    + [f"CAST(lag(demand, {n}) OVER w AS DOUBLE) AS lag_{n}h" for n in (1, 24, 168)]
)
WINDOWS = """WINDOW w AS (PARTITION BY region ORDER BY timestamp_ms),
         w3 AS (PARTITION BY region ORDER BY timestamp_ms
                ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         w24 AS (PARTITION BY region ORDER BY timestamp_ms
                 ROWS BETWEEN 23 PRECEDING AND CURRENT ROW),
         w168 AS (PARTITION BY region ORDER BY timestamp_ms
                  ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)"""
ROLLED = HOURLY + f""", rolled AS (
  SELECT region, timestamp_ms, demand,
         {ROLL_COLUMNS},
         lead(demand) OVER w AS target
  FROM hourly {WINDOWS})"""


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual demand with a model value (last hour) and a published one (a day before)."""
    columns = {"prediction": F.col("lag_1h"), "forecast": F.col("lag_24h")}
    return rolled(spark, sf_dir).withColumns(columns).select(
        "region", "timestamp_ms", "demand", "prediction", "forecast"
    )


TRIPLES = HOURLY + """, triples AS (
  SELECT region, timestamp_ms, demand,
         CAST(lag(demand, 1) OVER w AS DOUBLE) AS prediction,
         CAST(lag(demand, 24) OVER w AS DOUBLE) AS forecast
  FROM hourly WINDOW w AS (PARTITION BY region ORDER BY timestamp_ms))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction per feature hour: the three-hour mean, or demand before it exists."""
    rows = rolling.add_means(hourly(spark, sf_dir), SERIES)
    value = F.coalesce(F.col("mean_3"), F.col("demand").cast("double"))
    return rows.select("region", "timestamp_ms", value.alias("prediction"))


SCORED = ROLLED + """, scored AS (
  SELECT region, timestamp_ms, coalesce(mean_3, CAST(demand AS DOUBLE)) AS prediction
  FROM rolled)"""


def profile_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.join_weather(hourly(spark, sf_dir), regional_weather(spark, sf_dir))
    return joined.withColumn("tz", dims.literal_lookup(EVENT_ZONES, F.col("region")))


def _case(pairs: dict[str, str], column: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {column} {whens} END"


def local_sql(instant: str, zone: str) -> str:
    return f"timezone({zone}, timezone('UTC', {instant}))"


PROFILE = HOURLY + ", " + WEATHER + f""", profile AS (
  SELECT *, isodow(local_t) >= 6 AS weekend, hour(local_t) AS hour
  FROM (SELECT h.region, h.timestamp_ms, h.demand, w.temperature AS weather_temperature,
               {local_sql("epoch_ms(h.timestamp_ms)", _case(EVENT_ZONES, "h.region"))} AS local_t
        FROM hourly h LEFT JOIN weather w USING (region, timestamp_ms)))"""

PRIORITY_ZONE_SQL = _case(PRIORITY_ZONES, "o_orderpriority")


def registry_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model versions: name, region, is_tuned, version, status."""
    part = table(spark, sf_dir, "part")
    tuned = F.col("p_size") > 25
    suffix = F.when(tuned, "_tuned").otherwise("_no_tuning")
    status = (
        F.when(F.col("p_retailprice") < 1200, "Production")
        .when(F.col("p_retailprice") < 1500, "Staging")
        .otherwise("Development")
    )
    version = F.concat_ws(".", F.col("p_size"), F.length("p_name"), F.col("p_partkey"))
    return part.select(
        F.concat("p_brand", suffix).alias("name"),
        F.col("p_type").alias("region"),
        tuned.alias("is_tuned"),
        version.alias("version"),
        status.alias("status"),
    )


REGISTRY = """versions AS (
  SELECT p_brand || CASE WHEN p_size > 25 THEN '_tuned' ELSE '_no_tuning' END AS name,
         p_type AS region, p_size > 25 AS is_tuned,
         p_size || '.' || length(p_name) || '.' || p_partkey AS version,
         CASE WHEN p_retailprice < 1200 THEN 'Production'
              WHEN p_retailprice < 1500 THEN 'Staging' ELSE 'Development' END AS status
  FROM part), ranked AS (
  SELECT *, CAST(string_split(version, '.') AS BIGINT[]) AS parts FROM versions)"""
