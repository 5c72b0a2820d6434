"""Row selection: whitelists, NULL rules, trims, latest versions and changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions.numbers import null_if_nan
from loadcast.functions.time import DAY_MS, HOUR_MS, floor_ms, utc_hour
from loadcast.operators.series import Series, carried


def invalid_keys(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` outside ``allowed``."""
    return df.select(key).distinct().join(allowed, key, "left_anti")


def require_valid(requested: list[str], allowed: tuple[str, ...]) -> list[str]:
    """Check job arguments before any job is started."""
    unknown = sorted(set(requested) - set(allowed))
    if unknown:
        raise ValueError(f"invalid regions {unknown}; valid are {sorted(allowed)}")
    return requested


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: null_if_nan(F.col(c).cast("double")) for c in floats})


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return nan_to_null(df).na.drop("any", subset=subset)


def _latest_time(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(ts).alias("_latest"))


def drop_incomplete_keep_last(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Drop rows with any NULL, but keep the latest row of each key (the open prediction).

    The latest time is an aggregate joined back: one row per key, which AQE broadcasts when
    its measured size allows and otherwise joins with skewed keys split.
    """
    complete = F.lit(True)
    for c in df.columns:
        complete = complete & F.col(c).isNotNull()
    return (
        df.join(_latest_time(df, key, ts), key)
        .filter(complete | (F.col(ts) == F.col("_latest")))
        .select(*df.columns)
    )


def trim_after_last_actual(
    df: DataFrame, s: Series, actual: str = "demand", forecast: str = "forecast"
) -> DataFrame:
    """Cut a series behind its last actual value.

    If that row also has a forecast, everything up to it and one row more stays; otherwise
    only rows with an actual value stay.  A series without any actual value vanishes.
    """
    has = F.col(actual).isNotNull()
    last = df.filter(has).groupBy(s.key).agg(
        F.max(s.ts).alias("_last"),
        F.max_by(F.col(forecast).isNotNull(), s.ts).alias("_open"),
    )

    def previous(state: Column, is_carry: Column, w) -> Column:
        return F.lag(state).over(w)

    rows = carried(df, s, F.col(s.ts), "_before", before=previous)
    keep_open = (F.col(s.ts) <= F.col("_last")) | (F.col("_before") == F.col("_last"))
    return (
        rows.join(last, s.key)
        .filter(F.when(F.col("_open"), keep_open).otherwise(has))
        .select(*df.columns)
    )


def page_cut(
    df: DataFrame, key: str | list[str], ts: str, page_rows: int, size: Column | None = None
):
    """Per key: whether the page is full, where to cut it, and where the next page starts.

    A full page ends at its last hour 23 and the next one starts at the following midnight;
    without an hour 23 it ends where it ends and the next one starts an hour later.  ``size``
    overrides the fullness count with an aggregate over the raw rows of the page.
    """
    keys = [key] if isinstance(key, str) else key
    counted = F.count(F.lit(1)) if size is None else size
    stats = df.groupBy(*keys).agg(
        counted.alias("page_size"),
        F.max(ts).alias("_end"),
        F.max(F.when(utc_hour(ts) == 23, F.col(ts))).alias("_day_end"),
    )
    full = F.col("page_size") >= page_rows
    cut = F.when(full, F.coalesce("_day_end", "_end")).otherwise(F.col("_end"))
    return stats.select(
        *keys,
        "page_size",
        cut.alias("cut_ms"),
        F.when(full, cut + HOUR_MS).alias("next_start_ms"),
    )


def complete_day_trim(df: DataFrame, key: str, ts: str, page_rows: int) -> DataFrame:
    cuts = page_cut(df, key, ts, page_rows)
    return df.join(cuts, key).filter(F.col(ts) <= F.col("cut_ms")).select(
        *df.columns, "next_start_ms"
    )


def trim_pages(
    df: DataFrame, key: str, page: str, ts: str, page_rows: int, size: str | None = None
) -> DataFrame:
    """Landed pages, each cut to complete days where a later page brings the rest again.

    Pages of a key follow each other in order of ``page``.  What a full page has behind its cut
    goes only from the first hour of a later page on, so no hour is lost, whatever was landed; the
    last page of a key stays whole.  ``size`` names a column with the raw rows behind each row.
    """
    counted = None if size is None else F.sum(size)
    cuts = page_cut(df, [key, page], ts, page_rows, counted).select(key, page, "cut_ms")
    starts = df.groupBy(key, page).agg(F.min(ts).alias("_start"))
    # One row per page: the window sees pages, not their rows.
    following = Window.partitionBy(key).orderBy(page).rowsBetween(1, Window.unboundedFollowing)
    bounds = cuts.join(starts, [key, page]).withColumn("_next", F.min("_start").over(following))
    covered = (F.col(ts) > F.col("cut_ms")) & (F.col(ts) >= F.col("_next"))
    kept = df.join(bounds, [key, page]).filter(~F.coalesce(covered, F.lit(False)))
    return kept.select(*df.columns)


def until_midnight(df: DataFrame, ts: str, end_ms: Column) -> DataFrame:
    """Rows up to and including midnight at the start of the end date."""
    return df.filter(F.col(ts) <= floor_ms(end_ms, DAY_MS))


def dedupe_latest(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key, the one with the highest ``seq``.

    An aggregate, not a window: tasks keep one candidate per key before the shuffle, and no
    task has to sort all rows of a hot key.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


GROUP_LIMIT = 1_000  # default of spark.sql.optimizer.windowGroupLimitThreshold


def last_n(df: DataFrame, s: Series, n: int, ties: list[str] | None = None) -> DataFrame:
    """The latest ``n`` rows of each series, for any ``n``; rows without time come last.

    Two plans with the same rows.  Up to Spark's group-limit threshold the planner turns the rank
    filter into a limit on both sides of the shuffle, and a task sends at most ``n`` rows per key.
    Beyond, the counts of chunks, summed from the newest one backwards, tell which chunks are in,
    and only rows within a chunk are ranked: no task sees a whole series.
    """
    order = [F.col(s.ts).desc(), *[F.col(c).desc() for c in ties or []]]
    if n <= GROUP_LIMIT:
        w = Window.partitionBy(s.key).orderBy(*order)
        ranked = df.withColumn("_rank", F.row_number().over(w))
        return ranked.filter(f"_rank <= {int(n)}").drop("_rank")
    chunk = F.coalesce(s.chunk, F.lit(-(2**62)))
    counts = df.groupBy(F.col(s.key).alias("_key"), chunk.alias("_at"))
    counts = counts.agg(F.count(F.lit(1)).alias("_count"))
    newer = Window.partitionBy("_key").orderBy(F.desc("_at"))
    newer = newer.rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(n) - F.coalesce(F.sum("_count").over(newer), F.lit(0))
    kept = counts.select("_key", "_at", room.alias("_room")).filter("_room > 0")
    rows = df.withColumn("_chunk", chunk)
    same = F.col(s.key).eqNullSafe(F.col("_key")) & (F.col("_chunk") == F.col("_at"))
    w = Window.partitionBy(s.key, "_chunk").orderBy(*order)
    ranked = rows.join(kept, same).withColumn("_rank", F.row_number().over(w))
    return ranked.filter("_rank <= _room").select(*df.columns)


def latest_row(df: DataFrame, key: str, ts: str) -> DataFrame:
    return dedupe_latest(df, [key], ts)


def changes(df: DataFrame, s: Series, watched: list[str]) -> DataFrame:
    """Rows whose watched values differ from the row before (the first row always counts)."""
    def differs(state: Column, is_carry: Column, w) -> Column:
        previous = F.lag(state).over(w)
        return previous.isNull() | ~previous.eqNullSafe(state)

    state = F.struct(*[F.col(c) for c in watched])
    flagged = carried(df, s, state, "_changed", before=differs)
    return flagged.filter("_changed").drop("_changed")
