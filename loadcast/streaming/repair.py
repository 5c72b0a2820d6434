"""Features behind corrections that are older than the streaming state, from the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions.time import utc_date
from loadcast.operators.rolling import LONGEST, add_rolling
from loadcast.operators.series import Series
from loadcast.schemas import LAGS, ROLLING_COLUMNS
from loadcast.session import materialise
from loadcast.store.tables import COUNTS, FeatureTable

REACH = max(LONGEST, *LAGS)


def affected_days(counts: DataFrame, touched: DataFrame, key: str, reach: int = REACH) -> DataFrame:
    """Days whose rows may lie within ``reach`` rows behind a touched day, and those they look back on.

    ``counts`` has a row (key, event_date, n) for each day of a series, ``touched`` the keys and dates
    with a correction.  Returns (key, event_date, changed): days with ``changed`` are to be computed
    again, the others only give their history.  Days are counted in rows, so gaps don't matter.
    """
    series = counts.join(touched.select(key).distinct(), key, "left_semi")
    hits = touched.select(key, "event_date", F.lit(True).alias("hit"))
    days = Window.partitionBy(key).orderBy("event_date")
    so_far = days.rowsBetween(Window.unboundedPreceding, 0)
    later = days.rowsBetween(1, Window.unboundedFollowing)
    series = series.join(hits, [key, "event_date"], "left")
    series = series.withColumn("stop", F.sum("n").over(so_far))
    series = series.withColumn("start", F.col("stop") - F.col("n"))
    hit_stop = F.last(F.when(F.col("hit"), F.col("stop")), ignorenulls=True).over(so_far)
    changed = F.coalesce(F.col("start") - hit_stop < reach, F.lit(False))
    series = series.withColumn("changed", changed)
    next_start = F.first(F.when(F.col("changed"), F.col("start")), ignorenulls=True).over(later)
    series = series.withColumn("ahead", next_start - F.col("stop"))
    wanted = F.col("changed") | (F.col("ahead") < reach)
    return series.where(wanted).select(key, "event_date", "changed")


def repair_features(table: FeatureTable, late: DataFrame, batch_id: str) -> None:
    """Compute the features again that corrected hours change, and upsert them.

    ``late`` holds the keys and times of corrections that the table has taken already.  The days
    to read follow from the table's summary; their rows go through the same windows as a batch.
    """
    key, ts = table.meta.primary_key[0], table.meta.event_time
    touched = late.select(key, utc_date(ts).alias("event_date")).distinct()
    summary = table.summary()
    if "demand" not in summary.schema[COUNTS].dataType.names:
        return
    counts = summary.select(key, "event_date", F.col(f"{COUNTS}.demand").alias("n"))
    days = materialise(affected_days(counts, touched, key), "stale-days")
    dates = [r[0] for r in days.select(F.col("event_date").cast("string")).distinct().collect()]
    rows = table.read_dates(dates).select(key, ts, "demand", "event_date")
    rows = materialise(rows.join(days, [key, "event_date"]), "stale-rows")
    whole = add_rolling(rows.where("demand IS NOT NULL"), Series(key, ts))
    without = rows.where("demand IS NULL")
    without = without.withColumns({c: F.lit(None).cast("double") for c in ROLLING_COLUMNS})
    found = whole.unionByName(without).where("changed").select(key, ts, *ROLLING_COLUMNS)
    table.upsert(found, batch_id)
