"""Shape changes: typed records, long/wide metrics, renames, prefixes, melts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.functions.numbers import whole_number
from loadcast.functions.time import parse_period
from loadcast.schemas import METRICS, SCORING_ALIASES


def typed_records(raw: DataFrame, *keep: str) -> DataFrame:
    """Raw (period, respondent, type, value) text rows to typed long rows.

    A value that is no integer becomes NULL.  ``keep`` names columns to carry along.
    """
    return raw.select(
        parse_period("period").alias("timestamp_ms"),
        F.col("period").alias("human_read_period"),
        F.col("respondent").alias("region"),
        whole_number(F.col("value")).alias("electricity_demand"),
        F.col("type").alias("electricity_demand_type"),
        *keep,
    )


def known_types(df: DataFrame, column: str = "electricity_demand_type", strict: bool = False):
    """Keep the closed set of metric types; in strict mode another type fails the job."""
    known = F.col(column).isin(*METRICS)
    if strict:
        message = F.concat(F.lit("unknown metric type: "), F.coalesce(F.col(column), F.lit("null")))
        return df.filter(F.when(known, True).otherwise(F.raise_error(message).cast("boolean")))
    return df.filter(known)


def merge_metrics(long: DataFrame, seq: str) -> DataFrame:
    """One row per (hour, region) with the four metrics; the latest ``seq`` of a type wins.

    One aggregation instead of three full outer joins: each task first reduces its own rows,
    so a hot region sends at most one partial row per hour and task.
    """
    kind = F.col("electricity_demand_type")
    metrics = [
        F.max_by("electricity_demand", F.when(kind == code, F.col(seq))).alias(name)
        for code, name in METRICS.items()
    ]
    return (
        known_types(long)
        # The period text belongs to the hour; as a key it keeps the aggregate hash-based.
        .groupBy("timestamp_ms", "human_read_period", "region")
        .agg(*metrics)
    )


def pivot_metrics(long: DataFrame) -> DataFrame:
    """Strict long to wide: two rows for one (hour, region, type) fail the job."""
    kind = F.col("electricity_demand_type")
    per_type = []
    for code in METRICS:
        hit = kind == code
        value = F.max(F.when(hit, F.col("electricity_demand")))
        duplicate = F.count(F.when(hit, 1)) > 1
        error = F.raise_error(F.lit(f"duplicate {code} rows for one hour and region"))
        per_type.append(F.when(duplicate, error.cast("bigint")).otherwise(value).alias(code))
    return long.groupBy("timestamp_ms", "region").agg(*per_type)


def rename_metrics(wide: DataFrame) -> DataFrame:
    """Pivoted type codes to the scoring names, in scoring order."""
    names = {code: SCORING_ALIASES.get(name, name) for code, name in METRICS.items()}
    return wide.withColumnsRenamed(names).select("timestamp_ms", "region", *names.values())


def canonical_metrics(wide: DataFrame) -> DataFrame:
    """Scoring names back to the names used everywhere else."""
    return wide.withColumnsRenamed({alias: name for name, alias in SCORING_ALIASES.items()})


def prefix_columns(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.select(
        *[F.col(c) if c in keys else F.col(c).alias(f"{prefix}{c}") for c in df.columns]
    )


def existing(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order (schema check only)."""
    return [c for c in wanted if c in df.columns]


def melt_series(
    df: DataFrame, ids: list[str], labels: dict[str, str], name: str = "Series", value: str = "Value"
) -> DataFrame:
    """Wide to long with display labels; columns the frame lacks are left out."""
    present = existing(df, list(labels))
    wide = df.select(*ids, *[F.col(c).cast("double").alias(labels[c]) for c in present])
    return wide.unpivot(ids, [labels[c] for c in present], name, value)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def drop_for_training(df: DataFrame) -> DataFrame:
    """Columns the model must not see (fixed list); unknown names are ignored by drop."""
    return df.drop(
        "human_read_period",
        "hour_category",
        "weather_region",
        "weather_timestamp_ms",
        "weather_human_read_period",
        "ti",
        "ng",
    )


def labelled(c: Column, labels: dict) -> Column:
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.create_map(*pairs)[c]
