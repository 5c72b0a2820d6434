"""Sources, projections, filters, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadcast import dims
from loadcast.catalog import inputs as i
from loadcast.catalog.registry import query, r, rs
from loadcast.functions.time import DAY_MS, HOUR_MS, event_time
from loadcast.operators import joins, quality, ranges, reshape
from loadcast.schemas import WEATHER_FIELDS, WEATHER_MEASURES
from loadcast.session import materialise
from loadcast.sources import payloads, topics

AS_OF_MS = 1_706_454_000_000  # 2024-01-28T15:00 UTC, inside the event range


@query(
    "json_explode",
    "WITH " + i.RAW + """
    SELECT period, respondent, type, value FROM raw
    UNION ALL SELECT period, respondent, 'S' AS type, CAST(seq AS VARCHAR) AS value FROM raw""",
)
def json_explode(spark, sf_dir):
    """Nested payload text to raw rows: two array elements per payload."""
    first = F.struct("period", "respondent", "type", "value")
    second = F.struct(
        "period", "respondent", F.lit("S").alias("type"), F.col("seq").cast("string").alias("value")
    )
    document = F.struct(F.struct(F.array(first, second).alias("data")).alias("response"))
    return payloads.demand_from_text(
        i.raw_long(spark, sf_dir).select(F.to_json(document).alias("value"))
    )


@query(
    "weather_arrays",
    "WITH " + i.CITY_WEATHER + f""", paired AS (
      SELECT * FROM city_weather
      UNION ALL SELECT * REPLACE (timestamp_ms + 3600000 AS timestamp_ms) FROM city_weather)
    SELECT region, city, timestamp_ms,
           strftime(epoch_ms(timestamp_ms), '%Y-%m-%dT%H:%M') AS human_read_period,
           {rs(*WEATHER_MEASURES)} FROM paired""",
)
def weather_arrays(spark, sf_dir):
    """Parallel arrays to rows; the optional radiation arrays are absent when missing."""
    rows = i.city_weather(spark, sf_dir)
    later = F.date_format(event_time(F.col("timestamp_ms") + HOUR_MS), "yyyy-MM-dd'T'HH:mm")
    arrays = [F.array("human_read_period", later).alias("time")]
    for field, name in WEATHER_FIELDS.items():
        values = F.array(name, name)
        if field in payloads.OPTIONAL_WEATHER_FIELDS:
            values = F.when(F.col(name).isNotNull(), values)
        arrays.append(values.alias(field))
    return payloads.explode_weather(
        rows.select(F.lit(200).alias("status"), "region", "city", F.struct(*arrays).alias("hourly"))
    )


@query(
    "array_default",
    "WITH " + i.CITY_WEATHER + f"""
    SELECT region, city, timestamp_ms, 2 AS n_values, {r("solar_radiation", "value")}
    FROM city_weather""",
)
def array_default(spark, sf_dir):
    times = F.array("timestamp_ms", F.col("timestamp_ms") + HOUR_MS)
    given = F.when(
        F.col("solar_radiation").isNotNull(), F.array("solar_radiation", "solar_radiation")
    )
    filled = i.city_weather(spark, sf_dir).withColumn("_v", payloads.or_missing(given, times))
    return filled.select(
        "region",
        "city",
        "timestamp_ms",
        F.size("_v").alias("n_values"),
        F.element_at("_v", 1).alias("value"),
    )


@query(
    "event_time",
    "WITH " + i.HOURLY + """
    SELECT region, demand, CAST(epoch_ms(timestamp_ms) AS VARCHAR) AS event_time FROM hourly""",
)
def event_time_query(spark, sf_dir):
    ts = F.date_format(event_time("timestamp_ms"), "yyyy-MM-dd HH:mm:ss")
    return i.hourly(spark, sf_dir).select("region", "demand", ts.alias("event_time"))


@query(
    "to_json_kv",
    "WITH " + i.HOURLY + """
    SELECT region AS key,
           CAST(to_json({'region': region, 'timestamp_ms': timestamp_ms, 'demand': demand})
                AS VARCHAR) AS value
    FROM hourly""",
)
def to_json_kv(spark, sf_dir):
    return topics.encode(i.hourly(spark, sf_dir))


@query(
    "json_ops",
    "WITH " + i.MERGED + """
    SELECT region, timestamp_ms, human_read_period, demand, forecast, ti, ng,
           CAST(demand AS VARCHAR) AS demand_text FROM merged""",
)
def json_ops(spark, sf_dir):
    """Encode to a topic message and decode it again; NULL fields survive as absent ones."""
    from loadcast.schemas import DEMAND_RECORD

    messages = topics.encode(i.merged(spark, sf_dir))
    parsed = messages.select(
        F.from_json("value", DEMAND_RECORD).alias("_v"),
        F.get_json_object("value", "$.demand").alias("demand_text"),
    )
    return parsed.select("_v.*", "demand_text")


@query(
    "project_raw",
    "WITH " + i.TYPED + """
    SELECT timestamp_ms, human_read_period, region, electricity_demand, electricity_demand_type
    FROM typed""",
)
def project_raw(spark, sf_dir):
    return reshape.typed_records(i.raw_long(spark, sf_dir))


@query(
    "type_filter",
    "WITH " + i.TYPED + """
    SELECT * FROM typed WHERE electricity_demand_type IN ('D', 'DF', 'TI', 'NG')""",
)
def type_filter(spark, sf_dir):
    return reshape.known_types(i.typed(spark, sf_dir))


@query(
    "rename_reorder",
    "WITH " + i.MERGED + """
    SELECT timestamp_ms, region, demand, forecast AS demand_forecast, ti AS total_interchange,
           ng AS net_generation FROM merged""",
)
def rename_reorder(spark, sf_dir):
    codes = {name: code for code, name in reshape.METRICS.items()}
    return reshape.rename_metrics(i.merged(spark, sf_dir).withColumnsRenamed(codes))


@query(
    "prefix_columns",
    "WITH " + i.WEATHER + "SELECT region, timestamp_ms, "
    + "human_read_period AS weather_human_read_period, "
    + ", ".join(r(m, f"weather_{m}") for m in WEATHER_MEASURES)
    + " FROM weather",
)
def prefix_columns(spark, sf_dir):
    weather = i.regional_weather(spark, sf_dir)
    return reshape.prefix_columns(weather, "weather_", ["region", "timestamp_ms"])


@query(
    "drop_columns",
    "WITH " + i.MERGED + "SELECT timestamp_ms, region, demand, forecast FROM merged",
)
def drop_columns(spark, sf_dir):
    return reshape.drop_for_training(i.merged(spark, sf_dir))


@query(
    "facet_page",
    "WITH " + i.RAW + """
    SELECT * FROM raw
    WHERE respondent = 'view' AND period BETWEEN '2024-01-03T00' AND '2024-01-24T00'
    ORDER BY period, seq LIMIT 5000 OFFSET 0""",
)
def facet_page(spark, sf_dir):
    """One page of the source protocol: the limit is the operator."""
    raw = i.raw_long(spark, sf_dir)
    return ranges.facet_page(
        raw, "view", "2024-01-03T00", "2024-01-24T00", order=("period", "seq")
    )


@query(
    "batch_time_range",
    "WITH " + i.HOURLY + """
    SELECT * FROM hourly WHERE timestamp_ms BETWEEN 1704844800000 AND 1705881600000""",
)
def batch_time_range(spark, sf_dir):
    window = ranges.TimeRange(1_704_844_800_000, 1_705_881_600_000)
    return i.hourly(spark, sf_dir).filter(window.contains("timestamp_ms"))


@query(
    "shifted_range",
    "WITH " + i.HOURLY + f"""
    SELECT * FROM hourly
    WHERE timestamp_ms BETWEEN {AS_OF_MS} - 192 * 3600000 - 10 * 86400000
                           AND {AS_OF_MS} - 192 * 3600000""",
)
def shifted_range(spark, sf_dir):
    window = ranges.shifted_range(AS_OF_MS, last_n_days=10)
    return i.hourly(spark, sf_dir).filter(window.contains("timestamp_ms"))


@query(
    "day_aligned_range",
    "WITH " + i.HOURLY + f"""
    SELECT h.* FROM hourly h, (SELECT epoch_ms({AS_OF_MS}) AS t)
    WHERE timestamp_ms >= epoch_ms(date_trunc('day', t - INTERVAL 240 HOUR))
      AND timestamp_ms < epoch_ms(date_trunc('day', t + INTERVAL 24 HOUR))""",
)
def day_aligned_range(spark, sf_dir):
    window = ranges.day_aligned_range(AS_OF_MS, hours_back=240)
    return i.hourly(spark, sf_dir).filter(window.contains("timestamp_ms", closed=False))


@query(
    "cutoff_midnight",
    "WITH " + i.HOURLY + f"""
    SELECT * FROM hourly
    WHERE timestamp_ms <= epoch_ms(date_trunc('day', epoch_ms({AS_OF_MS})))""",
)
def cutoff_midnight(spark, sf_dir):
    return quality.until_midnight(i.hourly(spark, sf_dir), "timestamp_ms", F.lit(AS_OF_MS))


@query("region_filter", "WITH " + i.HOURLY + "SELECT * FROM hourly WHERE region = 'view'")
def region_filter(spark, sf_dir):
    return i.hourly(spark, sf_dir).filter(F.col("region") == "view")


@query(
    "invalid_regions",
    "WITH " + i.HOURLY + """
    SELECT DISTINCT region FROM hourly
    WHERE region NOT IN (SELECT event_type FROM events WHERE value > 100
                         AND event_type IN ('view', 'click'))""",
)
def invalid_regions(spark, sf_dir):
    allowed = (
        i.events(spark, sf_dir)
        .filter((F.col("value") > 100) & F.col("event_type").isin("view", "click"))
        .select(F.col("event_type").alias("region"))
        .distinct()
    )
    return quality.invalid_keys(i.hourly(spark, sf_dir), allowed, "region")


@query(
    "except_regions",
    """SELECT n_name AS region FROM nation
       EXCEPT SELECT n.n_name FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey
              WHERE s.s_acctbal > 9000""",
)
def except_regions(spark, sf_dir):
    """Requested minus valid, as a set difference."""
    nation = i.table(spark, sf_dir, "nation")
    supplier = i.table(spark, sf_dir, "supplier").filter("s_acctbal > 9000")
    valid = joins.lookup(
        supplier.withColumnRenamed("s_nationkey", "n_nationkey"), nation, "n_nationkey"
    )
    return nation.select(F.col("n_name").alias("region")).subtract(valid.select("n_name"))


@query(
    "semi_join",
    """SELECT c_custkey, c_nationkey, EXISTS (
             SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
             AS has_open
       FROM customer
       WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey)""",
)
def semi_join(spark, sf_dir):
    """Existence tests: a filter (semi join) and a flag."""
    customer = i.table(spark, sf_dir, "customer")
    supplier = i.table(spark, sf_dir, "supplier")
    orders = i.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    kept = customer.join(supplier, customer.c_nationkey == supplier.s_nationkey, "left_semi")
    pending = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    flagged = kept.join(pending.withColumn("_hit", F.lit(True)), "c_custkey", "left")
    return flagged.select("c_custkey", "c_nationkey", F.col("_hit").isNotNull().alias("has_open"))


@query(
    "dropna_any",
    "WITH " + i.MERGED + """
    SELECT * FROM merged WHERE demand IS NOT NULL AND forecast IS NOT NULL
       AND ti IS NOT NULL AND ng IS NOT NULL""",
)
def dropna_any(spark, sf_dir):
    return quality.drop_incomplete(i.merged(spark, sf_dir))


@query("dropna_subset", "WITH " + i.MERGED + "SELECT * FROM merged WHERE demand IS NOT NULL")
def dropna_subset(spark, sf_dir):
    return quality.drop_incomplete(i.merged(spark, sf_dir), ["demand"])


@query(
    "dropna_keep_last",
    "WITH " + i.MERGED + """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY timestamp_ms DESC) AS rn
      FROM merged)
    WHERE rn = 1 OR (demand IS NOT NULL AND forecast IS NOT NULL AND ti IS NOT NULL
                     AND ng IS NOT NULL)""",
)
def dropna_keep_last(spark, sf_dir):
    return quality.drop_incomplete_keep_last(i.merged_table(spark, sf_dir), "region", "timestamp_ms")


@query(
    "trim_last_valid",
    "WITH " + i.MERGED + """, placed AS (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY timestamp_ms) AS rn
      FROM merged), ends AS (
      SELECT region, max(rn) AS last_rn, arg_max(forecast IS NOT NULL, rn) AS open_end
      FROM placed WHERE demand IS NOT NULL GROUP BY region)
    SELECT timestamp_ms, human_read_period, p.region, demand, forecast, ti, ng
    FROM placed p JOIN ends e ON p.region = e.region
    WHERE CASE WHEN open_end THEN rn <= last_rn + 1 ELSE demand IS NOT NULL END""",
)
def trim_last_valid(spark, sf_dir):
    return quality.trim_after_last_actual(i.merged_table(spark, sf_dir), i.SERIES)


@query(
    "complete_day_trim",
    "WITH " + i.MERGED + """, stats AS (
      SELECT region, count(*) AS n, max(timestamp_ms) AS last_ms,
             max(timestamp_ms) FILTER (WHERE human_read_period LIKE '%T23') AS day_end
      FROM merged GROUP BY region), cuts AS (
      SELECT region, n >= 60 AS is_full,
             CASE WHEN n >= 60 THEN coalesce(day_end, last_ms) ELSE last_ms END AS cut
      FROM stats)
    SELECT m.*, CASE WHEN is_full THEN cut + 3600000 END AS next_start_ms
    FROM merged m JOIN cuts c ON m.region = c.region WHERE timestamp_ms <= cut""",
)
def complete_day_trim(spark, sf_dir):
    return quality.complete_day_trim(i.merged_table(spark, sf_dir), "region", "timestamp_ms", 60)


@query("landed_pages", "WITH " + i.MERGED + "SELECT * FROM merged")
def landed_pages(spark, sf_dir):
    """Overlapping pages of three days and half a day more: trimmed, they are every hour once."""
    merged = i.merged(spark, sf_dir)
    day = F.floor(F.col("timestamp_ms") / DAY_MS)
    half = (F.floor(F.col("timestamp_ms") / HOUR_MS) % 24 < 12) & (day % 3 == 0)
    page = F.floor(day / 3)
    pages = F.when(half, F.array(page - 1, page)).otherwise(F.array(page))
    landed = materialise(merged.withColumn("page", F.explode(pages)), "pages")
    kept = quality.trim_pages(landed, "region", "page", "timestamp_ms", 1)
    # A page that begins with the overlap has no hour before it; repeats agree.
    return kept.drop("page").distinct()


@query(
    "page_boundaries",
    "WITH " + i.MERGED + """
    SELECT region, n AS page_size, cut AS cut_ms,
           CASE WHEN n >= 1250 THEN cut + 3600000 END AS next_start_ms
    FROM (SELECT region, count(*) AS n,
                 CASE WHEN count(*) >= 1250
                      THEN coalesce(max(timestamp_ms) FILTER
                                    (WHERE human_read_period LIKE '%T23'), max(timestamp_ms))
                      ELSE max(timestamp_ms) END AS cut
          FROM merged GROUP BY region)""",
)
def page_boundaries(spark, sf_dir):
    return quality.page_cut(i.merged(spark, sf_dir), "region", "timestamp_ms", 1250)


@query(
    "prediction_shift",
    "WITH " + i.SCORED + f"""
    SELECT region, timestamp_ms + 3600000 AS timestamp_ms, {r("prediction")} FROM scored""",
)
def prediction_shift(spark, sf_dir):
    return joins.shift_predictions(i.scored(spark, sf_dir))


@query(
    "status_filter",
    """SELECT event_id, status, value FROM (
         SELECT event_id, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
                round(value, 6) AS value FROM events) WHERE status = 200""",
)
def status_filter(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", 500).otherwise(200)
    rows = i.events(spark, sf_dir).select("event_id", status.alias("status"), "value")
    return payloads.successful(rows)


@query(
    "union_all",
    "WITH " + i.CITY_WEATHER + f"""
    SELECT region, city, timestamp_ms, {rs("temperature", "humidity")}, 'low' AS band
    FROM city_weather WHERE temperature < 5000
    UNION ALL
    SELECT region, city, timestamp_ms, {rs("temperature", "humidity")}, 'high' AS band
    FROM city_weather WHERE temperature >= 5000""",
)
def union_all(spark, sf_dir):
    rows = i.city_weather(spark, sf_dir).select(
        "region", "city", "timestamp_ms", "temperature", "humidity"
    )
    low = rows.filter("temperature < 5000").withColumn("band", F.lit("low"))
    high = rows.filter("temperature >= 5000").withColumn("band", F.lit("high"))
    return reshape.union_all([low, high])


@query(
    "distinct_hours",
    "WITH " + i.CITY_WEATHER + """
    SELECT DISTINCT region, timestamp_ms FROM city_weather""",
)
def distinct_hours(spark, sf_dir):
    return i.city_weather(spark, sf_dir).select("region", "timestamp_ms").distinct()


SERIES_LABELS = {
    "prediction": "Predicted Demand",
    "demand": "Current Demand",
    "forecast": "Published Forecast",
    "not_there": "Absent",
}


@query(
    "melt_series",
    "WITH " + i.TRIPLES + f"""
    SELECT region, timestamp_ms, 'Predicted Demand' AS "Series", {r("prediction", '"Value"')}
    FROM triples
    UNION ALL SELECT region, timestamp_ms, 'Current Demand', {r("demand", '"Value"')} FROM triples
    UNION ALL SELECT region, timestamp_ms, 'Published Forecast', {r("forecast", '"Value"')}
    FROM triples""",
)
def melt_series(spark, sf_dir):
    return reshape.melt_series(
        i.triples(spark, sf_dir), ["region", "timestamp_ms"], SERIES_LABELS
    )


@query(
    "broadcast_lookup",
    """SELECT r_name, n_name, count(*) AS n_customers, round(sum(c_acctbal), 6) + 0.0 AS balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey
                     JOIN region ON n_regionkey = r_regionkey
       GROUP BY r_name, n_name""",
)
def broadcast_lookup(spark, sf_dir):
    """Dimension lookups before the aggregate; the files are small enough to broadcast."""
    customer = i.table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    nation = i.table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    region = i.table(spark, sf_dir, "region")
    places = joins.lookup(nation, region, "r_regionkey")
    return (
        joins.lookup(customer, places, "n_nationkey")
        .groupBy("r_name", "n_name")
        .agg(F.count(F.lit(1)).alias("n_customers"), F.sum("c_acctbal").alias("balance"))
    )


@query(
    "region_zone_lookup",
    "WITH " + i.HOURLY + f"""
    SELECT region, timestamp_ms, demand, {i._case(i.EVENT_ZONES, "region")} AS tz FROM hourly""",
)
def region_zone_lookup(spark, sf_dir):
    zones = dims.literal_lookup(i.EVENT_ZONES, F.col("region"))
    return i.hourly(spark, sf_dir).withColumn("tz", zones)
