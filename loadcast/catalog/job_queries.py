"""Stored tables, streams and models as queries; each works in its own scratch folder."""

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
from loadcast.catalog.series_queries import COMPLETE_SQL, SPARSE_SQL, _sparse_weather
from loadcast.dims import literal_lookup
from loadcast.functions.time import DAY_MS, HOUR_MS, utc_hour
from loadcast.models import boosted
from loadcast.models.boosted import Params
from loadcast.operators import quality, registry, reshape
from loadcast.operators.ranges import TimeRange
from loadcast.plans import features, scoring, training
from loadcast.schemas import (
    CALENDAR_COLUMNS,
    DEMAND_PAYLOAD,
    DEMAND_RECORD,
    METRICS,
    REGISTRY_RECORD,
    ROLLING_COLUMNS,
)
from loadcast.session import materialise, scratch_path, stream_session
from loadcast.sources import exports, payloads, topics
from loadcast.store.rejects import RejectTable
from loadcast.store.tables import FeatureStore, FeatureTable, Ledger, ViewMeta
from loadcast.streaming import jobs
from loadcast.streaming.state import REACH
from loadcast.streaming.watch import TapLedger, run_until_idle

S = i.SERIES
STATE_PARTITIONS = 8
MIDDLE_MS = 1_705_276_800_000  # 2024-01-15T00:00 UTC
EVENT_RANGE = TimeRange(MIDDLE_MS - 4 * DAY_MS, MIDDLE_MS + 9 * DAY_MS)


@query(
    "upsert_latest",
    "WITH " + i.HOURLY + f"""
    SELECT region, timestamp_ms,
           CASE WHEN timestamp_ms >= {MIDDLE_MS} THEN demand + 1 ELSE demand END AS demand,
           demand * 2 AS doubled,
           CASE WHEN timestamp_ms >= {MIDDLE_MS + DAY_MS} THEN demand * 3 END AS added
    FROM hourly""",
)
def upsert_latest(spark, sf_dir):
    """Insert all rows, correct the later half twice under one batch id, then add a column.

    The corrections lack a column, which keeps its values; the last batch has one more.
    """
    root = scratch_path(spark, "store")
    table = FeatureTable.get_or_create(spark, root, "demand", 1, "region", "timestamp_ms")
    hourly = i.hourly(spark, sf_dir)
    table.upsert(hourly.withColumn("doubled", F.col("demand") * 2), "load")
    late = hourly.filter(F.col("timestamp_ms") >= MIDDLE_MS)
    corrected = late.withColumn("demand", F.col("demand") + 1)
    table.upsert(corrected, "fix")
    table.upsert(corrected.withColumn("demand", F.col("demand") * 0), "fix")
    wider = late.filter(F.col("timestamp_ms") >= MIDDLE_MS + DAY_MS)
    wider = wider.select("region", "timestamp_ms", (F.col("demand") * 3).alias("added"))
    table.upsert(wider, "more")
    return table.read()


@query("upsert_last_write", "WITH " + i.MERGED + "SELECT region, timestamp_ms, demand FROM merged")
def upsert_last_write(spark, sf_dir):
    """One batch with every reading of an hour: the last one sent wins, wherever its row is."""
    root = scratch_path(spark, "store")
    table = FeatureTable.get_or_create(spark, root, "demand", 1, "region", "timestamp_ms")
    demand = F.when(F.col("electricity_demand_type") == "D", F.col("electricity_demand"))
    rows = reshape.known_types(i.typed(spark, sf_dir)).select(
        "region",
        "timestamp_ms",
        demand.alias("demand"),
        (F.col("electricity_demand_type") == "D").alias("is_demand"),
        "seq",
    )
    table.upsert(rows, "load", order_by=["is_demand", "seq"], leave_out=["is_demand", "seq"])
    return table.read()


@query(
    "feature_view_range",
    "WITH " + SPARSE_SQL + f"""
    SELECT h.region, h.timestamp_ms, h.demand, s.region AS weather_region,
           s.timestamp_ms AS weather_timestamp_ms, {r("s.temperature", "weather_temperature")}
    FROM hourly h ASOF LEFT JOIN sparse s
      ON h.region = s.region AND h.timestamp_ms >= s.timestamp_ms
    WHERE h.timestamp_ms BETWEEN {EVENT_RANGE.start_ms} AND {EVENT_RANGE.end_ms}""",
)
def feature_view_range(spark, sf_dir):
    """Two stored tables, a named view over them, and a time range of the view."""
    root = scratch_path(spark, "store")
    demand = FeatureTable.get_or_create(spark, root, "demand", 1, "region, timestamp_ms")
    demand.upsert(i.hourly(spark, sf_dir), "load")
    weather = FeatureTable.get_or_create(spark, root, "weather", 2, "region, timestamp_ms")
    sparse = _sparse_weather(spark, sf_dir).select("region", "timestamp_ms", "temperature")
    weather.upsert(sparse, "load")
    store = FeatureStore(spark, root)
    view = store.get_or_create_view(ViewMeta("load_view", 1, "demand", 1, "weather", 2))
    return store.read_view(view, EVENT_RANGE)


def _three_states(spark, sf_dir):
    """A table after a load, a correction of its later half, and one more hour for each region."""
    table = FeatureTable.get_or_create(spark, scratch_path(spark, "store"), "demand", 1, "region")
    hourly = i.hourly(spark, sf_dir)
    table.upsert(hourly, "load")
    late = hourly.filter(F.col("timestamp_ms") >= MIDDLE_MS)
    table.upsert(late.withColumn("demand", F.col("demand") + 1), "fix")
    newest = quality.latest_row(hourly, "region", "timestamp_ms")
    more = F.col("timestamp_ms") + HOUR_MS
    table.upsert(newest.withColumn("timestamp_ms", more), "more")
    return table


@query(
    "table_as_of",
    "WITH " + i.HOURLY + f""", fixed AS (
      SELECT region, timestamp_ms,
             CASE WHEN timestamp_ms >= {MIDDLE_MS} THEN demand + 1 ELSE demand END AS demand
      FROM hourly), newest AS (
      SELECT region, timestamp_ms + {HOUR_MS} AS timestamp_ms, demand FROM hourly
      QUALIFY row_number() OVER (PARTITION BY region ORDER BY timestamp_ms DESC) = 1)
    SELECT 1 AS state, * FROM hourly UNION ALL SELECT 2, * FROM fixed
    UNION ALL SELECT 3, * FROM fixed UNION ALL SELECT 3, * FROM newest""",
)
def table_as_of(spark, sf_dir):
    """Every published state of a table that was loaded, corrected and extended."""
    table = _three_states(spark, sf_dir)
    columns = ["region", "timestamp_ms", "demand"]
    states = [
        table.read(number=n).select(F.lit(n).alias("state"), *columns) for n in (1, 2, 3)
    ]
    return reshape.union_all(states)


@query(
    "table_summary",
    "WITH " + i.HOURLY + f""", fixed AS (
      SELECT region, timestamp_ms,
             CASE WHEN timestamp_ms >= {MIDDLE_MS} THEN demand + 1 ELSE demand END AS demand
      FROM hourly), newest AS (
      SELECT region, timestamp_ms + {HOUR_MS} AS timestamp_ms, demand FROM hourly
      QUALIFY row_number() OVER (PARTITION BY region ORDER BY timestamp_ms DESC) = 1),
    whole AS (SELECT * FROM fixed UNION ALL SELECT * FROM newest)
    SELECT region, CAST(make_timestamp(timestamp_ms * 1000) AS DATE) AS event_date,
           count(*) AS n_rows, count(demand) AS n_demand, max(timestamp_ms) AS last_ms,
           max_by(demand, timestamp_ms) AS last_demand
    FROM whole GROUP BY ALL""",
)
def table_summary(spark, sf_dir):
    """What a table keeps for each region and date beside its rows, after three upserts."""
    summary = _three_states(spark, sf_dir).summary()
    return summary.select(
        "region",
        "event_date",
        F.col("_rows").alias("n_rows"),
        F.col("_counts.demand").alias("n_demand"),
        F.col("_last.timestamp_ms").alias("last_ms"),
        F.col("_last.demand").alias("last_demand"),
    )


PARTITIONS = 4


def _write_messages(frame, path, days, corrected=False):
    """Three writes to a topic of four partitions, oldest first.

    ``corrected``: every seventh hour is sent one write too late, every eleventh with a wrong
    value before its right one, every fifth a second time at the end, and every 31st is wrong
    until the end.
    """
    first, second = (MIDDLE_MS + d * DAY_MS for d in days)
    ms, hour = F.col("timestamp_ms"), F.floor(F.col("timestamp_ms") / HOUR_MS)
    piece = F.when(ms < first, 0).when(ms < second, 1).otherwise(2)
    frame = frame.withColumn("_piece", piece)
    sent = frame
    if corrected:
        late = F.least(F.lit(2), piece + F.when(hour % 7 == 0, 1).otherwise(0))
        sent = frame.withColumn("_piece", late)
        wrong = frame.where(hour % 11 == 0).withColumn("demand", F.col("demand") + 1000)
        wrong = wrong.where((hour % 7 == 0) & (F.col("_piece") < 2))
        again = frame.where((hour % 5 == 0) | (hour % 31 == 0)).withColumn("_piece", F.lit(3))
        falsely = F.when(hour % 31 == 0, F.col("demand") * 2 + 1).otherwise(F.col("demand"))
        sent = sent.withColumn("demand", falsely)
        sent = sent.unionByName(wrong).unionByName(again)
    sent = materialise(sent, "messages")
    for k in range(4 if corrected else 3):
        part = sent.where(F.col("_piece") == k).drop("_piece").repartition(PARTITIONS, "region")
        topics.write_topic(part, {"path": path}, kind="files")


def _feature_table(spark, sf_dir, corrected):
    spark = stream_session(spark, STATE_PARTITIONS)
    root = scratch_path(spark, "stream")
    _write_messages(i.merged(spark, sf_dir), f"{root}/topic", (-5, 5), corrected)
    # Each write is one micro-batch or more.
    options = {"path": f"{root}/topic", "maxFilesPerTrigger": str(PARTITIONS)}
    messages = topics.read_topic(spark, options, kind="files")
    table = FeatureTable.get_or_create(spark, root, "features", 1, "region", "timestamp_ms")
    # A short reach, so that some corrections are older than the state.
    stream = jobs.feature_stream(messages, reach=48 if corrected else REACH)
    query_ = jobs.to_table(stream, table, f"{root}/checkpoint", "run")
    query_.awaitTermination()
    names = [*DEMAND_RECORD.names, *ROLLING_COLUMNS, *CALENDAR_COLUMNS]
    return query_, table.read().select(*names)


STREAM_SQL = "WITH " + i.MERGED + ", " + HOLIDAYS + f""", hourly AS (
      SELECT region, timestamp_ms, demand FROM merged WHERE demand IS NOT NULL), rolled AS (
      SELECT region, timestamp_ms, {i.ROLL_COLUMNS} FROM hourly {i.WINDOWS}),
    timed AS (
      SELECT *, make_timestamp(timestamp_ms * 1000) AS t FROM merged),
    dated AS (
      SELECT *, {CATEGORY_SQL} AS hour_category FROM timed)
    SELECT m.region, m.timestamp_ms, m.human_read_period, m.demand, m.forecast, m.ti, m.ng,
           {rs(*ROLLING_COLUMNS)}, hour_category,
           {category_number_sql("hour_category")} AS hour_category_num,
           CAST(CAST(t AS DATE) IN (SELECT day FROM holidays) AS INTEGER) AS is_holiday,
           {", ".join(r(sql, name) for name, sql in CYCLIC_SQL.items())}
    FROM dated m LEFT JOIN rolled r
      ON m.region = r.region AND m.timestamp_ms = r.timestamp_ms"""


@query("stream_features", STREAM_SQL)
def stream_features(spark, sf_dir):
    """Topic to keyed state to table, over several micro-batches; equals the batch windows."""
    return _feature_table(spark, sf_dir, corrected=False)[1]


@query("stream_features_late", STREAM_SQL)
def stream_features_late(spark, sf_dir):
    """The same with late, wrong and repeated messages; the last one of an hour counts."""
    return _feature_table(spark, sf_dir, corrected=True)[1]


@query(
    "stream_tap",
    "WITH " + i.MERGED + "SELECT count(*) AS messages, max(timestamp_ms) AS newest_ms FROM merged",
)
def stream_tap(spark, sf_dir):
    """What the ledger of taps has of a live stream: all messages, and the newest event time."""
    spark = stream_session(spark, STATE_PARTITIONS)
    root = scratch_path(spark, "tap")
    _write_messages(i.merged(spark, sf_dir), f"{root}/topic", (-5, 5))
    options = {"path": f"{root}/topic", "maxFilesPerTrigger": str(PARTITIONS)}
    messages = topics.decode(topics.read_topic(spark, options, kind="files"), DEMAND_RECORD)
    tapped = jobs.observed(messages.drop("event_time"), "tap")
    ledger = TapLedger(spark, root)
    spark.streams.addListener(ledger)
    try:
        # Polled like a live job, and stopped when nothing more comes.
        query_ = jobs.to_topic(
            tapped, {"path": f"{root}/out"}, f"{root}/checkpoint", kind="files", live="1 second"
        )
        run_until_idle(query_, ledger, idle_s=6.0, check_s=1.0)
    finally:
        spark.streams.removeListener(ledger)
    values = ledger.taps().where("tap = 'tap'").select("values.rows", "values.newest_ms")
    return values.agg(F.sum("rows").alias("messages"), F.max("newest_ms").alias("newest_ms"))


@query(
    "stream_readings",
    "WITH " + i.MERGED + """
    SELECT * FROM merged WHERE timestamp_ms IN (
      SELECT max(timestamp_ms) FROM merged m WHERE m.region = merged.region)""",
)
def stream_readings(spark, sf_dir):
    """Polled payloads; the second poll repeats the first one, so it emits nothing."""
    spark = stream_session(spark, STATE_PARTITIONS)
    root = scratch_path(spark, "poll")
    keys = ["region", "timestamp_ms", "electricity_demand_type"]
    latest = quality.dedupe_latest(reshape.known_types(i.typed(spark, sf_dir)), keys, "seq")
    record = F.struct(
        F.col("human_read_period").alias("period"),
        F.col("region").alias("respondent"),
        F.col("electricity_demand_type").alias("type"),
        F.col("electricity_demand").cast("string").alias("value"),
    )
    payload = F.struct(F.array(record).alias("data")).alias("response")
    for _ in range(2):
        latest.select(payload).write.mode("append").json(f"{root}/payloads")
    payloads = spark.readStream.schema(DEMAND_PAYLOAD).json(f"{root}/payloads")
    out = {"path": f"{root}/topic"}
    stream = jobs.live_readings(payloads)
    jobs.to_topic(stream, out, f"{root}/checkpoint", kind="files").awaitTermination()
    sent = topics.read_topic(spark, out, kind="files", streaming=False)
    return topics.decode(sent, DEMAND_RECORD).drop("event_time")


# Some periods, regions, types and values are made unusable; some values are missing.
FAULTY = i.RAW + """, faulty AS (
      SELECT CASE WHEN seq % 97 = 0 THEN replace(period, 'T', ' ') ELSE period END AS period,
             CASE WHEN seq % 89 = 0 THEN 'elsewhere' ELSE respondent END AS respondent, type,
             CASE WHEN seq % 83 = 0 THEN NULL ELSE value END AS value, seq FROM raw),
    judged AS (
      SELECT *, CASE WHEN seq % 97 = 0 THEN 'bad period'
                     WHEN type NOT IN ('D', 'DF', 'TI', 'NG') THEN 'unknown type'
                     WHEN seq % 89 = 0 THEN 'unknown region'
                     WHEN value IS NOT NULL AND TRY_CAST(value AS BIGINT) IS NULL
                     THEN 'bad number' END AS reason FROM faulty)"""


def _split_stream(spark, sf_dir):
    """Raw rows polled in two runs of one checkpoint; the accepted ones go to a table."""
    root = scratch_path(spark, "split")
    seq = F.col("seq")
    faulty = i.raw_long(spark, sf_dir).withColumns(
        {
            "period": F.when(seq % 97 == 0, F.replace("period", F.lit("T"), F.lit(" "))).otherwise(F.col("period")),
            "respondent": F.when(seq % 89 == 0, "elsewhere").otherwise(F.col("respondent")),
            "value": F.when(seq % 83 != 0, F.col("value")),
        }
    )
    schema = faulty.schema
    rejects = RejectTable(spark, root)
    table = FeatureTable.get_or_create(spark, root, "readings", 1, "arrival", "timestamp_ms")

    def use(rows, name):
        table.upsert(reshape.typed_records(rows, F.col("seq").alias("arrival")), name)

    for part in range(2):
        faulty.where(seq % 2 == part).write.mode("append").json(f"{root}/polled")
        raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", "4").json(f"{root}/polled")
        run = jobs.split_rejects(raw, i.EVENT_ZONES, rejects, use, f"{root}/checkpoint", "run")
        run.awaitTermination()
    return rejects.read(schema), table.read()


@query(
    "rejected_rows",
    "WITH " + FAULTY + """
    SELECT reason, seq, period, respondent, type, value FROM judged WHERE reason IS NOT NULL""",
)
def rejected_rows(spark, sf_dir):
    """Every row that a polled stream could not use, with the reason; restarted in between."""
    return _split_stream(spark, sf_dir)[0].drop("batch")


@query(
    "accepted_rows",
    "WITH " + FAULTY + """
    SELECT epoch_ms(strptime(period, '%Y-%m-%dT%H')) AS timestamp_ms, period AS human_read_period,
           respondent AS region, CAST(value AS BIGINT) AS electricity_demand,
           type AS electricity_demand_type, seq AS arrival
    FROM judged WHERE reason IS NULL""",
)
def accepted_rows(spark, sf_dir):
    """The other side of the split: the stored readings."""
    return _split_stream(spark, sf_dir)[1].drop("event_date")


@query(
    "csv_export",
    "WITH " + i.MERGED + "SELECT timestamp_ms, region, demand, forecast, ti, ng FROM merged",
)
def csv_export(spark, sf_dir):
    path = scratch_path(spark, "csv")
    columns = ["timestamp_ms", "region", *METRICS.values()]
    wide = i.merged(spark, sf_dir).select(*columns)
    exports.write_csv(wide, path)
    return spark.read.schema(wide.schema).option("header", True).csv(path)


# A target that one split on one feature explains: a tree of depth 1 reproduces it exactly.
STUMP = Params(maxIter=1, maxDepth=1)
LEVEL = Params(maxIter=1, maxDepth=0)
SMALL_MODEL = training.TrainingOptions(params=STUMP, status="Production")
STEP_SQL = "CASE WHEN (timestamp_ms // 3600000) % 24 >= 12 THEN 1500 ELSE 500 END"
FOLDS = 2


def _view(spark, sf_dir):
    """Demand features, written as a table would be, with the weather known at their time."""
    rows = materialise(features.demand_features(i.hourly(spark, sf_dir), S), "features")
    right = i.regional_weather(spark, sf_dir).select("region", "timestamp_ms", "temperature")
    return materialise(features.feature_view(rows, right, S), "view")


def _with_step(rows):
    return rows.withColumn("afternoon", (utc_hour("timestamp_ms") >= 12).cast("int"))


def _split(view):
    split = _with_step(features.training_split(view, S))
    return split.withColumn("target", F.col("afternoon") * 1000 + 500)


@query(
    "model_training",
    "WITH " + COMPLETE_SQL + f""", parts AS (
      SELECT *, {STEP_SQL} AS step, CASE WHEN rn <= floor(CAST(n AS DOUBLE)
               * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE))) THEN 'train' ELSE 'test' END AS split
      FROM complete)
    SELECT region, split, 'baseline' AS model, {r("avg(abs(step - demand))", "mae")}
    FROM parts GROUP BY region, split
    UNION ALL SELECT DISTINCT region, split, 'model', 0.0 FROM parts""",
)
def model_training(spark, sf_dir):
    """Errors of one model per region beside the baseline; the model has learnt the step."""
    errors, _ = training.train_regions(_split(_view(spark, sf_dir)), sorted(i.EVENT_ZONES), S, SMALL_MODEL)
    return errors


@query(
    "model_scoring",
    "WITH " + i.HOURLY + f"""
    SELECT region, timestamp_ms, CAST({STEP_SQL} AS DOUBLE) AS prediction FROM hourly""",
)
def model_scoring(spark, sf_dir):
    """Train, register what beats the baseline, load it again and score every hour."""
    view = _view(spark, sf_dir)
    errors, models = training.train_regions(_split(view), sorted(i.EVENT_ZONES), S, SMALL_MODEL)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    training.register_better(errors, models, ledger, "run", "1.0.0", SMALL_MODEL)
    loaded = scoring.load_models(ledger, sorted(i.EVENT_ZONES), "Production")
    return scoring.score(_with_step(reshape.drop_for_training(view)), loaded)


@query(
    "model_search",
    "WITH " + COMPLETE_SQL + f""", parts AS (
      SELECT region, timestamp_ms, {STEP_SQL} AS step, rn - 1 AS rn,
             CAST(floor(CAST(n AS DOUBLE) * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE))) AS BIGINT) AS n
      FROM complete), folds AS (
      SELECT *, n // {FOLDS + 1} AS part FROM parts, (VALUES (0), (1)) f(fold) WHERE rn < n),
    roles AS (
      SELECT *, rn < n - ({FOLDS} - fold) * part AS is_train FROM folds
      WHERE rn < n - ({FOLDS} - 1 - fold) * part), levels AS (
      SELECT region, fold, avg(step) AS level FROM roles WHERE is_train GROUP BY ALL)
    SELECT r.region, r.fold, 'level' AS candidate, {r("avg(abs(step - level))", "mae")}, false AS chosen
    FROM roles r JOIN levels l ON r.region = l.region AND r.fold = l.fold
    WHERE NOT is_train GROUP BY r.region, r.fold
    UNION ALL SELECT DISTINCT region, fold, 'stump', 0.0, true FROM roles WHERE NOT is_train""",
)
def model_search(spark, sf_dir):
    """Fold errors of two candidates per region; the one that can learn the step is chosen."""
    split = training.by_region(_split(_view(spark, sf_dir)).filter("split = 'train'"))
    names = {STUMP.params_id: "stump", LEVEL.params_id: "level"}
    parts = []
    for region in sorted(i.EVENT_ZONES):
        train = split.filter(F.col("region") == region)
        best, scores = boosted.search(train, [LEVEL, STUMP], S, FOLDS)
        chosen = (F.col("params_id") == best.params_id).alias("chosen")
        label = literal_lookup(names, F.col("params_id")).alias("candidate")
        parts.append(scores.select("region", "fold", label, "mae", chosen))
    return reshape.union_all(parts)


@query(
    "run_log",
    "WITH " + COMPLETE_SQL + f""", parts AS (
      SELECT *, {STEP_SQL} AS step, CASE WHEN rn <= floor(CAST(n AS DOUBLE)
               * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE))) THEN 'train' ELSE 'test' END AS split
      FROM complete), shapes AS (
      SELECT region, split, count(*) AS n_rows, min(timestamp_ms) AS first_ms,
             max(timestamp_ms) AS last_ms FROM parts GROUP BY ALL)
    SELECT 'run' AS run_id, region, name, value FROM (
      SELECT region, 'rows_' || split AS name, CAST(n_rows AS VARCHAR) AS value FROM shapes
      UNION ALL SELECT region, 'first_ms_' || split, CAST(first_ms AS VARCHAR) FROM shapes
      UNION ALL SELECT region, 'last_ms_' || split, CAST(last_ms AS VARCHAR) FROM shapes
      UNION ALL SELECT NULL, 'n_splits', '4')""",
)
def run_log(spark, sf_dir):
    """Split shapes, time extents and parameters of a run, as the ledger gives them back."""
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    ledger.log_parameters("run", {"n_splits": 4})
    training.log_shapes(_split(_view(spark, sf_dir)), ledger, "run")
    return ledger.runs()


@query(
    "state_shapes",
    """SELECT n_name AS state, r_name AS region, 'Polygon' AS geometry_type,
              '[[' || n_nationkey || ',' || n_regionkey || ']]' AS coordinates
       FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 0""",
)
def state_shapes(spark, sf_dir):
    """Shapes of the states of known regions from a GeoJSON document of all nations."""
    root = scratch_path(spark, "shapes")
    nation = i.table(spark, sf_dir, "nation")
    text = "[[%s,%s]]"
    place = F.format_string(text, F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), place.alias("coordinates")).alias("geometry"),
        F.struct(F.col("n_name").alias("NAME")).alias("properties"),
    )
    # One document, as such files are: nation has 25 rows at any scale.
    nation.agg(F.collect_list(feature).alias("features")).write.json(root)
    region = i.table(spark, sf_dir, "region")
    states = nation.filter("n_nationkey % 5 <> 0").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    states = states.select(F.col("n_name").alias("state"), F.col("r_name").alias("region"))
    shapes = payloads.read_state_shapes(spark, root, states)
    return shapes.select(
        F.col("NAME").alias("state"),
        "region",
        F.col("geometry.type").alias("geometry_type"),
        F.col("geometry.coordinates").alias("coordinates"),
    )


@query(
    "registry_scan",
    "WITH " + i.REGISTRY + "SELECT name, region, is_tuned, version, status FROM versions",
)
def registry_scan(spark, sf_dir):
    """Nested registry documents (all versions of a model in one) to one row per version."""
    rows = i.registry_versions(spark, sf_dir)
    entry = F.struct("version", "status", F.lit("run").alias("experiment_key"))
    nested = rows.groupBy("name", "region", "is_tuned").agg(F.collect_list(entry).alias("versions"))
    path = scratch_path(spark, "registry")
    nested.write.json(path)
    found = registry.versions_long(spark.read.schema(REGISTRY_RECORD).json(path))
    return found.drop("experiment_key")
