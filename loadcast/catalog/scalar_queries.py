"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadcast import dims
from loadcast.catalog import inputs as i
from loadcast.catalog.registry import query, r
from loadcast.functions import numbers, text, time

HOLIDAYS = """fixed AS (
  SELECT make_date(CAST(y AS INTEGER), m, d) AS day, y
  FROM range(1994, 2031) t(y), (VALUES (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) f(m, d)
  WHERE NOT (m = 6 AND y < 2021)), monthly AS (
  SELECT CAST(d AS DATE) AS day, year(d) AS y, month(d) AS m, isodow(d) AS dow,
         (day(d) + 6) // 7 AS nth, month(d + INTERVAL 7 DAY) <> month(d) AS is_last
  FROM range(TIMESTAMP '1994-01-01', TIMESTAMP '2031-01-01', INTERVAL 1 DAY) t(d)), holidays AS (
  SELECT day FROM fixed
  UNION SELECT day - 1 FROM fixed WHERE isodow(day) = 6
  UNION SELECT day + 1 FROM fixed WHERE isodow(day) = 7
  UNION SELECT day FROM monthly
        WHERE (m IN (1, 2) AND dow = 1 AND nth = 3) OR (m = 5 AND dow = 1 AND is_last)
           OR (m = 9 AND dow = 1 AND nth = 1) OR (m = 10 AND dow = 1 AND nth = 2)
           OR (m = 11 AND dow = 4 AND nth = 4))"""


@query(
    "holiday_flag",
    "WITH " + i.CALENDAR + ", " + HOLIDAYS + """
    SELECT o_orderkey, strftime(t, '%Y-%m-%d') AS day,
           CAST(CAST(t AS DATE) IN (SELECT day FROM holidays) AS INTEGER) AS is_holiday
    FROM calendar""",
)
def holiday_flag(spark, sf_dir):
    orders = i.calendar(spark, sf_dir).withColumn("day", time.utc_date("timestamp_ms"))
    flagged = time.with_holiday(orders, "day")
    return flagged.select("o_orderkey", F.col("day").cast("string").alias("day"), "is_holiday")


@query(
    "parse_period",
    "WITH " + i.RAW + """
    SELECT seq, epoch_ms(strptime(period, '%Y-%m-%dT%H')) AS timestamp_ms FROM raw""",
)
def parse_period(spark, sf_dir):
    raw = i.raw_long(spark, sf_dir)
    return raw.select("seq", time.parse_period("period").alias("timestamp_ms"))


@query(
    "parse_minute_period",
    "WITH " + i.CITY_WEATHER + """
    SELECT city, epoch_ms(strptime(human_read_period, '%Y-%m-%dT%H:%M')) AS timestamp_ms
    FROM city_weather""",
)
def parse_minute_period(spark, sf_dir):
    ms = time.parse_minute_period("human_read_period")
    return i.city_weather(spark, sf_dir).select("city", ms.alias("timestamp_ms"))


@query(
    "format_period",
    "WITH " + i.CALENDAR + """
    SELECT o_orderkey, strftime(t, '%Y-%m-%dT%H') AS period,
           strftime(t, '%Y-%m-%d') || 'T00' AS day_period FROM calendar""",
)
def format_period(spark, sf_dir):
    start = time.floor_ms("timestamp_ms", time.DAY_MS)
    return i.calendar(spark, sf_dir).select(
        "o_orderkey",
        time.format_period("timestamp_ms").alias("period"),
        time.format_period(start).alias("day_period"),
    )


@query(
    "time_parts",
    "WITH " + i.CALENDAR + """
    SELECT o_orderkey, CAST(hour(t) AS INTEGER) AS hour,
           CAST(isodow(t) - 1 AS INTEGER) AS day_of_week, CAST(month(t) AS INTEGER) AS month,
           CAST(isodow(t) >= 6 AS INTEGER) AS is_weekend FROM calendar""",
)
def time_parts(spark, sf_dir):
    ms, weekday = "timestamp_ms", time.utc_weekday("timestamp_ms")
    return i.calendar(spark, sf_dir).select(
        "o_orderkey",
        time.utc_hour(ms).alias("hour"),
        weekday.alias("day_of_week"),
        time.utc_month(ms).alias("month"),
        time.is_weekend(weekday).alias("is_weekend"),
    )


CATEGORY_SQL = """CASE WHEN isodow(t) >= 6
       THEN CASE WHEN hour(t) BETWEEN 18 AND 22 THEN 'evening_peak' ELSE 'off_peak' END
       WHEN hour(t) BETWEEN 9 AND 17 THEN 'office_hours'
       WHEN hour(t) BETWEEN 18 AND 22 THEN 'evening_peak' ELSE 'off_peak' END"""


def category_number_sql(category: str) -> str:
    return (
        f"CASE {category} WHEN 'off_peak' THEN 0 WHEN 'office_hours' THEN 1 ELSE 2 END"
    )


@query(
    "hour_category",
    "WITH " + i.CALENDAR + f"""
    SELECT o_orderkey, c AS hour_category, {category_number_sql("c")} AS hour_category_num
    FROM (SELECT o_orderkey, {CATEGORY_SQL} AS c FROM calendar)""",
)
def hour_category(spark, sf_dir):
    rows = time.with_calendar(i.calendar(spark, sf_dir))
    return rows.select("o_orderkey", "hour_category", "hour_category_num")


CYCLIC_SQL = {
    "hour_sin": "sin(2 * pi() * hour(t) / 24)",
    "hour_cos": "cos(2 * pi() * hour(t) / 24)",
    "day_of_week_sin": "sin(2 * pi() * (isodow(t) - 1) / 7)",
    "day_of_week_cos": "cos(2 * pi() * (isodow(t) - 1) / 7)",
    "month_sin": "sin(2 * pi() * month(t) / 12)",
    "month_cos": "cos(2 * pi() * month(t) / 12)",
}


@query(
    "cyclical_features",
    "WITH " + i.CALENDAR + "SELECT o_orderkey, "
    + ", ".join(r(sql, name) for name, sql in CYCLIC_SQL.items())
    + " FROM calendar",
)
def cyclical_features(spark, sf_dir):
    return time.with_calendar(i.calendar(spark, sf_dir)).select("o_orderkey", *CYCLIC_SQL)


PART_SQL = """CASE WHEN h < 6 THEN 'Night' WHEN h < 12 THEN 'Morning'
                   WHEN h < 18 THEN 'Afternoon' ELSE 'Evening' END"""


@query(
    "part_of_day",
    "WITH " + i.CALENDAR + f"""
    SELECT o_orderkey, {PART_SQL} AS part_of_day
    FROM (SELECT o_orderkey, hour(t) AS h FROM calendar)""",
)
def part_of_day(spark, sf_dir):
    part = time.part_of_day(time.utc_hour("timestamp_ms"))
    return i.calendar(spark, sf_dir).select("o_orderkey", part.alias("part_of_day"))


@query(
    "local_time",
    "WITH " + i.CALENDAR + f""", placed AS (
      SELECT o_orderkey, {i.local_sql("t", i.PRIORITY_ZONE_SQL)} AS lt FROM calendar)
    SELECT o_orderkey, strftime(lt, '%Y-%m-%d %H:%M:%S') AS local_time,
           CAST(hour(lt) AS INTEGER) AS hour, CAST(isodow(lt) - 1 AS INTEGER) AS day_of_week,
           CAST(month(lt) AS INTEGER) AS month, CAST(isodow(lt) >= 6 AS INTEGER) AS is_weekend,
           {PART_SQL.replace("h <", "hour(lt) <")} AS part_of_day
    FROM placed""",
)
def local_time(spark, sf_dir):
    """UTC to regional wall clock, daylight saving included."""
    zone = dims.literal_lookup(i.PRIORITY_ZONES, F.col("o_orderpriority"))
    columns = time.local_columns("timestamp_ms", zone)
    shown = F.date_format(columns.pop("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return i.calendar(spark, sf_dir).select(
        "o_orderkey", shown.alias("local_time"), *[c.alias(n) for n, c in columns.items()]
    )


@query(
    "int_cast",
    "WITH " + i.RAW + """
    SELECT seq, TRY_CAST(value AS BIGINT) AS whole,
           CAST(trunc(TRY_CAST(value AS DOUBLE) / 100) AS BIGINT) AS truncated FROM raw""",
)
def int_cast(spark, sf_dir):
    return i.raw_long(spark, sf_dir).select(
        "seq",
        numbers.whole_number(F.col("value")).alias("whole"),
        numbers.truncated(F.col("value").try_cast("double") / 100).alias("truncated"),
    )


@query(
    "string_ops",
    """SELECT p_partkey, ends_with(strftime(TIMESTAMP '2024-01-01' + to_hours(p_size),
                                           '%Y-%m-%dT%H'), 'T23') AS is_day_end,
              lower(p_brand) AS lower_name, upper(p_type) AS upper_name,
              contains(lower(p_name), 'widget') AS has_word,
              len(list_transform(string_split(p_name || ' , ' || p_brand, ','),
                                 lambda x: trim(x))) AS n_keys,
              trim(string_split(p_name || ' , ' || p_brand, ',')[2]) AS second_key,
              p_brand || '_gbt_model_' || CASE WHEN p_size > 25 THEN 'tuned'
                                               ELSE 'no_tuning' END AS model
       FROM part""",
)
def string_ops(spark, sf_dir):
    part = i.table(spark, sf_dir, "part")
    hour = F.lit(1_704_067_200_000) + F.col("p_size") * time.HOUR_MS
    keys = text.split_list(F.concat("p_name", F.lit(" , "), "p_brand"))
    return part.select(
        "p_partkey",
        text.ends_with_hour(time.format_period(hour), 23).alias("is_day_end"),
        F.lower("p_brand").alias("lower_name"),
        F.upper("p_type").alias("upper_name"),
        F.lower("p_name").contains("widget").alias("has_word"),
        F.size(keys).cast("bigint").alias("n_keys"),
        F.element_at(keys, 2).alias("second_key"),
        text.model_name(F.col("p_brand"), F.col("p_size") > 25).alias("model"),
    )


@query(
    "default_features",
    "SELECT n_name AS region, "
    + ", ".join(f"0.0::DOUBLE AS {c}" for c in i.rolling.ROLLING_COLUMNS)
    + " FROM nation",
)
def default_features(spark, sf_dir):
    """A frame without demand gets zero features."""
    nations = i.table(spark, sf_dir, "nation").select(F.col("n_name").alias("region"))
    return i.rolling.rolling_or_default(nations, i.SERIES)
