"""String, JSON and version expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(c: Column) -> Column:
    """Comma list to trimmed array."""
    return F.transform(F.split(c, ","), lambda x: F.trim(x))


def ends_with_hour(period: Column, hour: int) -> Column:
    return period.endswith(f"T{hour:02d}")


def model_name(region: Column, tuned: Column) -> Column:
    suffix = F.when(tuned, "tuned").otherwise("no_tuning")
    return F.concat_ws("_", region, F.lit("gbt_model"), suffix)


def message(columns: list[Column]) -> Column:
    return F.to_json(F.struct(*columns))


def version_key(version: Column) -> Column:
    """Sortable key of ``1.2.3`` or ``1.2.3rc1``: release numbers, final after pre-release.

    Release parts compare as numbers of up to 38 digits, however many there are; trailing zeros do not count, so
    ``1.2`` equals ``1.2.0``.
    """
    release = F.regexp_extract(version, r"^v?(\d+(?:\.\d+)*)", 1)
    suffix = F.regexp_replace(version, r"^v?\d+(?:\.\d+)*[-.]?", "")
    significant = F.regexp_replace(release, r"(?:\.0+)+$", "")
    parts = F.transform(F.split(significant, r"\."), lambda x: x.try_cast("decimal(38,0)"))
    stage = F.regexp_extract(suffix, r"^([a-z]+)", 1)
    number = F.coalesce(F.regexp_extract(suffix, r"(\d+)$", 1).try_cast("decimal(38,0)"), F.lit(0))
    return F.struct(
        parts.alias("release"),
        F.when(suffix == "", 1).otherwise(0).alias("is_final"),
        stage.alias("stage"),
        number.alias("number"),
    )
