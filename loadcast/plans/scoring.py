"""Batch scoring of all regions with their registered models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.models import boosted
from loadcast.operators import joins, quality, registry
from loadcast.operators.reshape import union_all
from loadcast.plans.training import by_region
from loadcast.session import materialise
from loadcast.store.tables import Ledger


def load_models(
    ledger: Ledger, regions: list[str], status: str, errors: dict[str, str] | None = None
) -> dict[str, PipelineModel]:
    """The picked model of each region; regions without one are left out.

    A model that cannot be read is left out as well; with ``errors`` its message goes there,
    otherwise it is raised.
    """
    known = ledger.models().filter(F.col("region").isin(regions))
    picked = registry.pick_models(known, status)
    paths = picked.join(known.select("name", "version", "path"), ["name", "version"])
    models = {}
    # One row per requested region.
    for row in paths.collect():
        try:
            models[row["region"]] = PipelineModel.load(row["path"])
        except Exception as failure:
            if errors is None:
                raise
            errors[row["region"]] = str(failure).splitlines()[0]
    return models


def score(features: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Predictions of every region that has a model; without models no rows.

    The features are laid out by region first, so that each model reads its own rows only.
    """
    if not models:
        return features.limit(0).select("region", "timestamp_ms", F.lit(0.0).alias("prediction"))
    rows = by_region(features) if len(models) > 1 else features
    parts = [
        boosted.predict(model, rows.filter(F.col("region") == region)).select(
            "region", "timestamp_ms", "prediction"
        )
        for region, model in models.items()
    ]
    return union_all(parts)


def prediction_table(
    features: DataFrame, forecast: DataFrame, models: dict[str, PipelineModel]
) -> DataFrame:
    """Predictions with forecast and features; per region only the open last row has NULLs."""
    scored = score(features, models)
    # Written once: finding the last rows must not run the models a second time.
    assembled = materialise(joins.assemble_predictions(scored, forecast, features), "scored")
    return quality.drop_incomplete_keep_last(assembled, "region", "timestamp_ms")


def region_status(
    features: DataFrame,
    models: dict[str, PipelineModel],
    requested: DataFrame,
    errors: dict[str, str] | None = None,
) -> DataFrame:
    """One row per requested region: scored, or why not (``status``, ``error``)."""
    rows = features.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"))
    has_model = F.col("region").isin(list(models))
    failed = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in {"": "", **(errors or {})}.items() for x in pair]),
        F.col("region"),
    )
    status = (
        F.when(failed.isNotNull(), "error")
        .when(~has_model, "no model")
        .when(F.col("n_rows").isNull(), "no features")
        .otherwise("ok")
    )
    joined = requested.join(rows, "region", "left")
    return joined.withColumns({"status": status, "error": failed})
