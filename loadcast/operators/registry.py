"""Choice of a registered model version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions.text import version_key


def versions_long(registry: DataFrame) -> DataFrame:
    return registry.select("name", "region", "is_tuned", F.explode("versions").alias("_v")).select(
        "name", "region", "is_tuned", "_v.*"
    )


def latest_versions(versions: DataFrame, status: str) -> DataFrame:
    """Per model name: number of versions with ``status`` and the highest of them."""
    return (
        versions.filter(F.col("status") == status)
        .groupBy("region", "name", "is_tuned")
        .agg(
            F.count(F.lit(1)).alias("n_versions"),
            F.max_by("version", version_key(F.col("version"))).alias("version"),
        )
    )


def pick_models(versions: DataFrame, status: str) -> DataFrame:
    """One model per region: tuned first, then most versions, highest version, name."""
    candidates = latest_versions(versions, status)
    descending = F.struct(
        F.col("is_tuned").cast("int").alias("tuned"),
        F.col("n_versions"),
        version_key(F.col("version")).alias("key"),
    )
    best = candidates.groupBy("region").agg(F.max(descending).alias("_best"))
    tied = candidates.join(best, "region").filter(descending == F.col("_best"))
    return tied.groupBy("region").agg(
        F.min("name").alias("name"), F.min_by("version", "name").alias("version")
    )
