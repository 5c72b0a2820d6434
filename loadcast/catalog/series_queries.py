"""Ordered operators, joins and aggregates over keyed series."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadcast.catalog import inputs as i
from loadcast.catalog.registry import query, r, rs
from loadcast.catalog.scalar_queries import (
    CATEGORY_SQL,
    CYCLIC_SQL,
    HOLIDAYS,
    category_number_sql,
)
from loadcast.functions.text import version_key
from loadcast.functions.time import HOUR_MS
from loadcast.operators import (
    evaluate,
    joins,
    profiles,
    quality,
    registry,
    reshape,
    rolling,
    splits,
    weather,
)
from loadcast.plans import features
from loadcast.operators.series import Series
from loadcast.schemas import ROLLING_COLUMNS, WEATHER_MEASURES
from loadcast.session import materialise

S = i.SERIES
MEANS = [c for c in ROLLING_COLUMNS if c.startswith("mean")]
MEDIANS = [c for c in ROLLING_COLUMNS if c.startswith("median")]
LAGS = [c for c in ROLLING_COLUMNS if c.startswith("lag")]
KEYS = "region, timestamp_ms, demand"


# --- windows ---------------------------------------------------------------------------


@query("rolling_mean", "WITH " + i.ROLLED + f"SELECT {KEYS}, {rs(*MEANS)} FROM rolled")
def rolling_mean(spark, sf_dir):
    return rolling.add_means(i.hourly(spark, sf_dir), S)


@query("rolling_median", "WITH " + i.ROLLED + f"SELECT {KEYS}, {rs(*MEDIANS)} FROM rolled")
def rolling_median(spark, sf_dir):
    return rolling.add_medians(i.hourly(spark, sf_dir), S)


@query("lag_features", "WITH " + i.ROLLED + f"SELECT {KEYS}, {rs(*LAGS)} FROM rolled")
def lag_features(spark, sf_dir):
    return rolling.add_lags(i.hourly(spark, sf_dir), S)


@query("lead_target", "WITH " + i.ROLLED + f"SELECT {KEYS}, target FROM rolled")
def lead_target(spark, sf_dir):
    return rolling.add_target(i.hourly(spark, sf_dir), S)


@query(
    "rolling_with_gaps",
    "WITH " + i.MERGED + f""", hourly AS (
      SELECT region, timestamp_ms, demand FROM merged WHERE demand IS NOT NULL)
    SELECT {KEYS}, {", ".join(r(f"x_{c}", c) for c in ROLLING_COLUMNS)} FROM (
      SELECT region, timestamp_ms, demand, {i.ROLL_COLUMNS
        .replace(" AS mean", " AS x_mean").replace(" AS median", " AS x_median")
        .replace(" AS lag", " AS x_lag")}
      FROM hourly {i.WINDOWS})""",
)
def rolling_with_gaps(spark, sf_dir):
    """Hours without demand leave the series before the frames are counted."""
    rows = i.merged(spark, sf_dir).select("region", "timestamp_ms", "demand")
    return rolling.add_rolling(rows, S)


@query(
    "last_n_per_key",
    "WITH " + i.HOURLY + """
    SELECT region, timestamp_ms, demand FROM (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY timestamp_ms DESC) AS rn
      FROM hourly) WHERE rn <= 168""",
)
def last_n_per_key(spark, sf_dir):
    return quality.last_n(i.hourly(spark, sf_dir), S, 168)


@query(
    "last_5000_per_key",
    """SELECT l_returnflag, l_orderkey, l_linenumber, ship_ms FROM (
      SELECT *, row_number() OVER (
               PARTITION BY l_returnflag ORDER BY ship_ms DESC, l_orderkey DESC, l_linenumber DESC) AS rn
      FROM (SELECT *, epoch_ms(CAST(l_shipdate AS TIMESTAMP)) AS ship_ms FROM lineitem))
    WHERE rn <= 5000""",
)
def last_5000_per_key(spark, sf_dir):
    """More rows than the planner limits by itself; a third of all rows and more share a key."""
    lines = i.table(spark, sf_dir, "lineitem")
    ship = F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ship_ms")
    lines = lines.select("l_returnflag", "l_orderkey", "l_linenumber", ship)
    return quality.last_n(lines, Series("l_returnflag", "ship_ms"), 5_000, ["l_orderkey", "l_linenumber"])


@query(
    "tail_120",
    "WITH " + i.TRIPLES + f"""
    SELECT region, timestamp_ms, demand, {rs("prediction", "forecast")} FROM (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY timestamp_ms DESC) AS rn
      FROM triples) WHERE rn <= 120""",
)
def tail_120(spark, sf_dir):
    return quality.last_n(i.triples(spark, sf_dir), S, 120)


@query(
    "dedupe_latest",
    "WITH " + i.TYPED + """
    SELECT timestamp_ms, human_read_period, region, electricity_demand,
           electricity_demand_type, seq FROM (
      SELECT *, row_number() OVER (PARTITION BY region, timestamp_ms ORDER BY seq DESC) AS rn
      FROM typed) WHERE rn = 1""",
)
def dedupe_latest(spark, sf_dir):
    return quality.dedupe_latest(i.typed(spark, sf_dir), ["region", "timestamp_ms"], "seq")


@query(
    "latest_per_region",
    "WITH " + i.HOURLY + """
    SELECT region, max(timestamp_ms) AS timestamp_ms, arg_max(demand, timestamp_ms) AS demand
    FROM hourly GROUP BY region""",
)
def latest_per_region(spark, sf_dir):
    return quality.latest_row(i.hourly(spark, sf_dir), "region", "timestamp_ms")


@query(
    "emit_on_change",
    "WITH " + i.MERGED + """, flags AS (
      SELECT region, timestamp_ms, demand IS NOT NULL AS has_demand,
             forecast IS NOT NULL AS has_forecast FROM merged)
    SELECT region, timestamp_ms, has_demand, has_forecast FROM (
      SELECT *, lag(has_demand) OVER w AS d, lag(has_forecast) OVER w AS f,
             row_number() OVER w AS rn
      FROM flags WINDOW w AS (PARTITION BY region ORDER BY timestamp_ms))
    WHERE rn = 1 OR d <> has_demand OR f <> has_forecast""",
)
def emit_on_change(spark, sf_dir):
    flags = i.merged(spark, sf_dir).select(
        "region",
        "timestamp_ms",
        F.col("demand").isNotNull().alias("has_demand"),
        F.col("forecast").isNotNull().alias("has_forecast"),
    )
    return quality.changes(flags, S, ["has_demand", "has_forecast"])


SPLIT_SQL = i.HOURLY + """, split AS (
      SELECT region, timestamp_ms, demand,
             CASE WHEN rn <= floor(CAST(n AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE)))
                  THEN 'train' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY timestamp_ms) AS rn,
                   count(*) OVER (PARTITION BY region) AS n FROM hourly))"""


@query("chrono_split", "WITH " + SPLIT_SQL + "SELECT * FROM split")
def chrono_split(spark, sf_dir):
    return splits.chrono_split(i.hourly_table(spark, sf_dir), S)


@query(
    "split_counts",
    "WITH " + SPLIT_SQL + "SELECT region, split, count(*) AS n_rows FROM split GROUP BY ALL",
)
def split_counts(spark, sf_dir):
    return splits.split_counts(splits.chrono_split(i.hourly_table(spark, sf_dir), S))


FOLD_SQL = i.HOURLY + """, folds AS (
      SELECT region, timestamp_ms, demand, fold,
             CASE WHEN rn < n - (4 - fold) * part THEN 'train' ELSE 'validate' END AS role
      FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY timestamp_ms) - 1 AS rn,
                   count(*) OVER (PARTITION BY region) AS n,
                   count(*) OVER (PARTITION BY region) // 5 AS part FROM hourly),
           (VALUES (0), (1), (2), (3)) f(fold)
      WHERE rn < n - (3 - fold) * part)"""


@query("time_series_folds", "WITH " + FOLD_SQL + "SELECT * FROM folds")
def time_series_folds(spark, sf_dir):
    return splits.time_series_folds(i.hourly_table(spark, sf_dir), S, 4)


@query(
    "fold_scores",
    "WITH " + FOLD_SQL + f""", means AS (
      SELECT region, fold, avg(demand) AS level FROM folds WHERE role = 'train' GROUP BY ALL),
    mae AS (
      SELECT f.region, f.fold, avg(abs(f.demand - m.level)) AS mae
      FROM folds f JOIN means m ON f.region = m.region AND f.fold = m.fold
      WHERE role = 'validate' GROUP BY ALL)
    SELECT region, 'mean' AS params_id, {r("avg(mae)", "mean_mae")} FROM mae GROUP BY region""",
)
def fold_scores(spark, sf_dir):
    """Cross-validation score of the training mean as the predictor."""
    folds = splits.time_series_folds(i.hourly_table(spark, sf_dir), S, 4)
    level = folds.filter("role = 'train'").groupBy("region", "fold").agg(F.avg("demand").alias("level"))
    held_out = folds.filter("role = 'validate'").join(level, ["region", "fold"])
    mae = evaluate.mae_by(held_out, ["region", "fold"], "demand", {"mean": "level"})
    return evaluate.cross_validation_score(mae.withColumnRenamed("model", "params_id"))


@query(
    "sort_region_time",
    "WITH " + i.HOURLY + "SELECT * FROM hourly ORDER BY region, timestamp_ms",
)
def sort_region_time(spark, sf_dir):
    return i.hourly(spark, sf_dir).orderBy("region", "timestamp_ms")


@query(
    "registry_pick",
    "WITH " + i.REGISTRY + """, candidates AS (
      SELECT region, name, is_tuned, count(*) AS n, max(parts) AS parts,
             arg_max(version, parts) AS version
      FROM ranked WHERE status = 'Production' GROUP BY ALL)
    SELECT region, name, version FROM (
      SELECT *, row_number() OVER (PARTITION BY region
                ORDER BY is_tuned DESC, n DESC, parts DESC, name) AS rn FROM candidates)
    WHERE rn = 1""",
)
def registry_pick(spark, sf_dir):
    return registry.pick_models(i.registry_versions(spark, sf_dir), "Production")


@query(
    "semver_sort",
    "WITH " + i.REGISTRY + """
    SELECT region, name, version, status, CAST(parts[1] AS INTEGER) AS major,
           CAST(parts[2] AS INTEGER) AS minor, CAST(parts[3] AS INTEGER) AS patch
    FROM ranked ORDER BY region, name, parts DESC""",
)
def semver_sort(spark, sf_dir):
    """Semantic order of versions: a range-partitioned sort, whatever a model's share."""
    versions = i.registry_versions(spark, sf_dir).withColumn("key", version_key(F.col("version")))
    release = [
        F.coalesce(F.try_element_at("key.release", F.lit(n)), F.lit(0)).cast("int").alias(part)
        for n, part in enumerate(("major", "minor", "patch"), 1)
    ]
    ordered = versions.orderBy("region", "name", F.desc("key"))
    return ordered.select("region", "name", "version", "status", *release)


# --- joins -----------------------------------------------------------------------------

SPARSE_SQL = i.HOURLY + ", " + i.WEATHER + """, sparse AS (
      SELECT * FROM weather WHERE temperature > 4000)"""


def _sparse_weather(spark, sf_dir):
    return i.regional_weather(spark, sf_dir).filter("temperature > 4000")


@query(
    "asof_join",
    "WITH " + SPARSE_SQL + f"""
    SELECT h.region, h.timestamp_ms, h.demand, s.region AS weather_region,
           s.timestamp_ms AS weather_timestamp_ms, {r("s.temperature", "weather_temperature")}
    FROM hourly h ASOF LEFT JOIN sparse s
      ON h.region = s.region AND h.timestamp_ms >= s.timestamp_ms""",
)
def asof_join(spark, sf_dir):
    right = _sparse_weather(spark, sf_dir).select("region", "timestamp_ms", "temperature")
    return joins.asof_join(i.hourly(spark, sf_dir), right, S, "weather_")


@query(
    "asof_join_tolerance",
    "WITH " + SPARSE_SQL + f"""
    SELECT h.region, h.timestamp_ms, h.demand,
           CASE WHEN h.timestamp_ms - s.timestamp_ms <= 7200000 THEN s.region END
             AS weather_region,
           CASE WHEN h.timestamp_ms - s.timestamp_ms <= 7200000 THEN s.timestamp_ms END
             AS weather_timestamp_ms,
           {r("CASE WHEN h.timestamp_ms - s.timestamp_ms <= 7200000 THEN s.temperature END",
              "weather_temperature")}
    FROM hourly h ASOF LEFT JOIN sparse s
      ON h.region = s.region AND h.timestamp_ms >= s.timestamp_ms""",
)
def asof_join_tolerance(spark, sf_dir):
    right = _sparse_weather(spark, sf_dir).select("region", "timestamp_ms", "temperature")
    hourly = i.hourly(spark, sf_dir)
    return joins.asof_join(hourly, right, S, "weather_", tolerance_ms=2 * HOUR_MS)


WEATHER_SELECT = ", ".join(r(f"w.{m}", f"weather_{m}") for m in WEATHER_MEASURES)


@query(
    "left_join_weather",
    "WITH " + i.HOURLY + ", " + i.WEATHER + f"""
    SELECT h.region, h.timestamp_ms, h.demand, {WEATHER_SELECT}
    FROM hourly h LEFT JOIN weather w
      ON h.region = w.region AND h.timestamp_ms = w.timestamp_ms""",
)
def left_join_weather(spark, sf_dir):
    return joins.join_weather(i.hourly(spark, sf_dir), i.regional_weather(spark, sf_dir))


@query(
    "merge_metrics",
    "WITH " + i.MERGED + "SELECT * FROM merged",
)
def merge_metrics(spark, sf_dir):
    return i.merged(spark, sf_dir)


@query(
    "prediction_assembly",
    "WITH " + i.SCORED + ", " + i.TYPED + i.MERGED[len(i.TYPED):] + f"""
    SELECT s.region, s.timestamp_ms + 3600000 AS timestamp_ms, {r("s.prediction", "prediction")},
           m.forecast, o.demand, {r("o.mean_24", "mean_24")}, {r("o.lag_24h", "lag_24h")}
    FROM scored s
    LEFT JOIN merged m ON m.region = s.region AND m.timestamp_ms = s.timestamp_ms + 3600000
    LEFT JOIN rolled o ON o.region = s.region AND o.timestamp_ms = s.timestamp_ms + 3600000""",
)
def prediction_assembly(spark, sf_dir):
    forecast = i.merged(spark, sf_dir).select("region", "timestamp_ms", "forecast")
    known = i.rolled(spark, sf_dir).select(
        "region", "timestamp_ms", "demand", "mean_24", "lag_24h"
    )
    return joins.assemble_predictions(i.scored(spark, sf_dir), forecast, known)


@query(
    "debug_join_future",
    "WITH " + i.SCORED + f""", shifted AS (
      SELECT region, timestamp_ms + 3600000 AS timestamp_ms, prediction FROM scored), matched AS (
      SELECT t.region, t.timestamp_ms, t.demand, CAST(t.lag_24h AS DOUBLE) AS forecast,
             s.prediction
      FROM rolled t JOIN shifted s ON t.region = s.region AND t.timestamp_ms = s.timestamp_ms)
    SELECT region, timestamp_ms, demand, {rs("forecast", "prediction")} FROM matched
    UNION ALL
    SELECT m.region, max(m.timestamp_ms) + 3600000, NULL, NULL,
           round(any_value(n.prediction), 6) + 0.0
    FROM matched m JOIN (SELECT region, arg_max(prediction, timestamp_ms) AS prediction
                         FROM scored GROUP BY region) n ON m.region = n.region
    GROUP BY m.region""",
)
def debug_join_future(spark, sf_dir):
    # One window pass gives the actual, the forecast and the prediction of every hour.
    rows = rolling.add_rolling(i.hourly(spark, sf_dir), S)
    value = F.coalesce(F.col("mean_3"), F.col("demand").cast("double"))
    columns = {"forecast": F.col("lag_24h"), "prediction": value}
    names = ["region", "timestamp_ms", "demand", "forecast", "prediction"]
    both = materialise(rows.withColumns(columns).select(*names), "scored")
    return joins.debug_predictions(both.drop("prediction"), both.drop("demand", "forecast"))


# --- aggregates ------------------------------------------------------------------------


@query(
    "pivot_metrics",
    "WITH " + i.TYPED + """, single AS (
      SELECT region, timestamp_ms, electricity_demand_type AS type,
             arg_max_null(electricity_demand, seq) AS v FROM typed GROUP BY 1, 2, 3)
    SELECT region, timestamp_ms, max(v) FILTER (WHERE type = 'D') AS "D",
           max(v) FILTER (WHERE type = 'DF') AS "DF", max(v) FILTER (WHERE type = 'TI') AS "TI",
           max(v) FILTER (WHERE type = 'NG') AS "NG"
    FROM single GROUP BY region, timestamp_ms""",
)
def pivot_metrics(spark, sf_dir):
    """Strict pivot, after one row per type has been chosen."""
    keys = ["region", "timestamp_ms", "electricity_demand_type"]
    single = quality.dedupe_latest(i.typed(spark, sf_dir), keys, "seq")
    return reshape.pivot_metrics(single)


@query(
    "region_mean",
    "WITH " + i.WEATHER + f"""
    SELECT region, timestamp_ms, human_read_period, {rs(*WEATHER_MEASURES)} FROM weather""",
)
def region_mean(spark, sf_dir):
    return weather.region_mean(i.city_weather(spark, sf_dir))


@query(
    "region_mean_strict",
    "WITH " + i.CITY_WEATHER + "SELECT region, timestamp_ms, "
    + "min(human_read_period) AS human_read_period, "
    + ", ".join(
        r(f"CASE WHEN count({m}) = count(*) THEN avg({m}) END", m) for m in WEATHER_MEASURES
    )
    + " FROM city_weather GROUP BY region, timestamp_ms",
)
def region_mean_strict(spark, sf_dir):
    return weather.region_mean(i.city_weather(spark, sf_dir), skip_nulls=False)


@query(
    "hourly_profile",
    "WITH " + i.PROFILE + f"""
    SELECT region, CAST(hour AS INTEGER) AS hour, {r("avg(demand)", "avg_demand")},
           {r("avg(weather_temperature)", "avg_temperature")}
    FROM profile GROUP BY region, hour""",
)
def hourly_profile(spark, sf_dir):
    return profiles.hourly_profile(profiles.with_local_time(i.profile_input(spark, sf_dir)))


@query(
    "weekday_weekend_profile",
    "WITH " + i.PROFILE + f"""
    SELECT region, CAST(hour AS INTEGER) AS hour, CAST(weekend AS INTEGER) AS is_weekend,
           {r("avg(demand)", "avg_demand")},
           CASE WHEN weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type
    FROM profile GROUP BY region, hour, weekend""",
)
def weekday_weekend_profile(spark, sf_dir):
    return profiles.weekend_profile(profiles.with_local_time(i.profile_input(spark, sf_dir)))


@query(
    "counts_rollup",
    "WITH " + i.HOURLY + "SELECT region, count(*) AS n_rows FROM hourly GROUP BY ROLLUP(region)",
)
def counts_rollup(spark, sf_dir):
    return profiles.counts_rollup(i.hourly(spark, sf_dir))


@query(
    "time_extent",
    "WITH " + i.HOURLY + """
    SELECT region, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms
    FROM hourly GROUP BY region""",
)
def time_extent(spark, sf_dir):
    return profiles.time_extent(i.hourly(spark, sf_dir))


@query(
    "axis_bounds",
    "WITH " + i.TRIPLES + f"""
    SELECT region, {r("least(min(prediction), min(demand), min(forecast)) - 1000", "axis_min")},
           {r("greatest(max(prediction), max(demand), max(forecast)) + 1000", "axis_max")}
    FROM triples GROUP BY region""",
)
def axis_bounds(spark, sf_dir):
    columns = ["prediction", "demand", "forecast"]
    return profiles.axis_bounds(i.triples(spark, sf_dir), ["region"], columns, 1000)


MAE_SQL = i.ROLLED + """, parts AS (
      SELECT *, CASE WHEN rn <= floor(CAST(n AS DOUBLE)
                                      * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE)))
                     THEN 'train' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY timestamp_ms) AS rn,
                   count(*) OVER (PARTITION BY region) AS n
            FROM rolled WHERE target IS NOT NULL AND lag_168h IS NOT NULL)), mae AS (
      SELECT region, split, 'baseline' AS model, avg(abs(target - demand)) AS mae
      FROM parts GROUP BY ALL
      UNION ALL SELECT region, split, 'model', avg(abs(target - mean_24))
      FROM parts GROUP BY region, split)"""


def _mae(spark, sf_dir):
    """Errors of a 24-hour mean against the persistence baseline, on test and train rows."""
    # Numbering reads its input twice (chunk index, rows); the feature windows run once.
    rows = materialise(quality.drop_incomplete(i.rolled(spark, sf_dir, target=True)), "rows")
    split = splits.chrono_split(rows, S)
    return evaluate.mae_by(
        evaluate.persistence(split),
        ["region", "split"],
        "target",
        {"baseline": "prediction", "model": "mean_24"},
    )


@query("mae_by_region", "WITH " + MAE_SQL + f"SELECT region, split, model, {r('mae')} FROM mae")
def mae_by_region(spark, sf_dir):
    return _mae(spark, sf_dir)


@query(
    "registration_gate",
    "WITH " + MAE_SQL + f"""
    SELECT region, {rs("mae_model", "mae_baseline")} FROM (
      SELECT region, max(mae) FILTER (WHERE model = 'model') AS mae_model,
             max(mae) FILTER (WHERE model = 'baseline') AS mae_baseline
      FROM mae WHERE split = 'test' GROUP BY region) WHERE mae_model < mae_baseline""",
)
def registration_gate(spark, sf_dir):
    return evaluate.registration_gate(_mae(spark, sf_dir).filter("split = 'test'"))


@query(
    "baseline_mae",
    "WITH " + i.ROLLED + f"""
    SELECT region, 'baseline' AS model, {r("avg(abs(target - demand))", "mae")}
    FROM rolled WHERE target IS NOT NULL GROUP BY region""",
)
def baseline_mae(spark, sf_dir):
    rows = rolling.add_target(i.hourly(spark, sf_dir), S).filter("target IS NOT NULL")
    return evaluate.mae_by(
        evaluate.persistence(rows), ["region"], "target", {"baseline": "prediction"}
    )


def _accuracy_sql(name: str) -> str:
    return f"""
      avg(abs(demand - {name})) AS {name}_mae,
      avg((demand - {name}) * (demand - {name})) AS {name}_mse,
      sqrt(avg((demand - {name}) * (demand - {name}))) AS {name}_rmse,
      avg(CASE WHEN demand <> 0 THEN abs((demand - {name}) / demand)
               WHEN {name} <> 0 THEN 0.0 END) * 100 AS {name}_mape,
      1 - sum((demand - {name}) * (demand - {name}))
          / (var_pop(demand) * count(demand)) AS {name}_r2"""


ACCURACY_SQL = i.TRIPLES + f""", measured AS (
      SELECT region, {_accuracy_sql("prediction")}, {_accuracy_sql("forecast")}
      FROM triples WHERE prediction IS NOT NULL AND forecast IS NOT NULL GROUP BY region)"""
MEASURES = list(evaluate.METRIC_LABELS)


@query(
    "accuracy_metrics",
    "WITH " + ACCURACY_SQL + "SELECT region, "
    + ", ".join(r(f"prediction_{m}", f"model_{m}") for m in MEASURES) + ", "
    + ", ".join(r(f"forecast_{m}") for m in MEASURES) + " FROM measured",
)
def accuracy_metrics(spark, sf_dir):
    return evaluate.accuracy(i.triples(spark, sf_dir), ["region"])


@query(
    "metrics_transposed",
    "WITH " + ACCURACY_SQL + " UNION ALL ".join(
        f"""SELECT region, '{label}' AS "Metric", {r(f"prediction_{m}", '"Model"')},
                   {r(f"forecast_{m}", '"Forecast"')} FROM measured"""
        for m, label in evaluate.METRIC_LABELS.items()
    ),
)
def metrics_transposed(spark, sf_dir):
    wide = evaluate.accuracy(i.triples(spark, sf_dir), ["region"])
    return evaluate.metrics_as_rows(wide, ["region"])


@query(
    "standardize",
    "WITH " + i.ROLLED + """
    SELECT region, timestamp_ms,
           round((demand - avg(demand) OVER p) / stddev_pop(demand) OVER p, 6) + 0.0 AS demand,
           round((lag_1h - avg(lag_1h) OVER p) / stddev_pop(lag_1h) OVER p, 6) + 0.0 AS lag_1h
    FROM rolled WINDOW p AS (PARTITION BY region)""",
)
def standardize(spark, sf_dir):
    rows = i.rolled(spark, sf_dir).select("region", "timestamp_ms", "demand", "lag_1h")
    # Moments first, then the rows: the window pass runs once.
    rows = materialise(rows, "lags")
    return evaluate.standardize(rows, "region", ["demand", "lag_1h"])


MI_BINS = 16


def _mi_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT region, '{f}' AS feature, {f} AS x, CAST(demand AS DOUBLE) AS y FROM dated "
        f"WHERE {f} IS NOT NULL AND timestamp_ms < newest"
        for f in ROLLING_COLUMNS
    )
    at = ", ".join(f"{k / MI_BINS}" for k in range(1, MI_BINS))
    return f"""
    , dated AS (SELECT *, max(timestamp_ms) OVER (PARTITION BY region) AS newest FROM rolled),
    long AS ({long}),
    bounds AS (SELECT region, feature, quantile_disc(x, [{at}]) AS xs, quantile_disc(y, [{at}]) AS ys
               FROM long GROUP BY ALL),
    binned AS (SELECT l.region, l.feature, len(list_filter(xs, lambda e: e < x)) AS bx,
                 len(list_filter(ys, lambda e: e < y)) AS by_
               FROM long l JOIN bounds b ON l.region = b.region AND l.feature = b.feature),
    joint AS (SELECT region, feature, bx, by_, CAST(count(*) AS DOUBLE) AS n
              FROM binned GROUP BY ALL),
    cells AS (SELECT *, sum(n) OVER (PARTITION BY region, feature, bx) AS nx,
                     sum(n) OVER (PARTITION BY region, feature, by_) AS ny,
                     sum(n) OVER (PARTITION BY region, feature) AS nt FROM joint)
    SELECT region, feature, {r("sum(n / nt * ln(n * nt / (nx * ny)))", "importance")}
    FROM cells GROUP BY region, feature ORDER BY region, importance DESC"""


@query("mutual_information", "WITH " + i.ROLLED + _mi_sql())
def mutual_information(spark, sf_dir):
    """Ranking of all rolling and lag features; a region's latest row is open and left out."""
    names = ["region", "timestamp_ms", "demand", *ROLLING_COLUMNS]
    rows = i.rolled(spark, sf_dir).select(*names)
    newest = rows.groupBy("region").agg(F.max("timestamp_ms").alias("newest"))
    # The ranking reads its input twice (bin bounds, then counts); the windows run once.
    closed = materialise(rows.join(newest, "region").filter("timestamp_ms < newest"), "closed")
    scores = evaluate.mutual_information(closed, "region", list(ROLLING_COLUMNS), "demand", MI_BINS)
    return scores.orderBy("region", F.desc("importance"))


# --- whole assemblies ------------------------------------------------------------------

CALENDAR_SELECT = f"""{CATEGORY_SQL} AS hour_category,
           CAST(CAST(t AS DATE) IN (SELECT day FROM holidays) AS INTEGER) AS is_holiday,
           """ + ", ".join(f"{sql} AS {name}" for name, sql in CYCLIC_SQL.items())
DOUBLES = [*CYCLIC_SQL, *ROLLING_COLUMNS]


@query(
    "feature_assembly",
    "WITH " + i.ROLLED + ", " + i.WEATHER + ", " + HOLIDAYS + f""", timed AS (
      SELECT *, {CALENDAR_SELECT}
      FROM (SELECT *, epoch_ms(timestamp_ms) AS t FROM rolled))
    SELECT f.region, f.timestamp_ms, f.demand, f.target, hour_category,
           {category_number_sql("hour_category")} AS hour_category_num, is_holiday,
           {rs(*DOUBLES)}, {WEATHER_SELECT}
    FROM timed f LEFT JOIN weather w
      ON f.region = w.region AND f.timestamp_ms = w.timestamp_ms""",
)
def feature_assembly(spark, sf_dir):
    """Flagship: every feature of every region and hour in one job."""
    hourly, regional = i.hourly(spark, sf_dir), i.regional_weather(spark, sf_dir)
    return features.assemble_features(hourly, regional, S, target=True)


COMPLETE_SQL = i.ROLLED + ", " + i.WEATHER + """, viewed AS (
      SELECT r.*, w.temperature AS weather_temperature
      FROM rolled r ASOF LEFT JOIN weather w
        ON r.region = w.region AND r.timestamp_ms >= w.timestamp_ms), complete AS (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY timestamp_ms) AS rn,
             count(*) OVER (PARTITION BY region) AS n
      FROM viewed WHERE target IS NOT NULL AND lag_168h IS NOT NULL
                    AND weather_temperature IS NOT NULL)"""


@query(
    "training_set",
    "WITH " + COMPLETE_SQL + """
    SELECT region, timestamp_ms, demand, """ + rs(*ROLLING_COLUMNS, "weather_temperature") + """,
           target, CASE WHEN rn <= floor(CAST(n AS DOUBLE)
                                         * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE)))
                        THEN 'train' ELSE 'test' END AS split
    FROM complete""",
)
def training_set(spark, sf_dir):
    """Point-in-time view, target, complete rows and chronological split."""
    right = i.regional_weather(spark, sf_dir).select(
        "region", "timestamp_ms", "human_read_period", "temperature"
    )
    view = features.feature_view(i.rolled(spark, sf_dir), right, S)
    return features.training_split(view, S)
