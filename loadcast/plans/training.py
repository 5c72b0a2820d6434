"""Train, evaluate and register one model per region."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.models import boosted
from loadcast.operators import evaluate
from loadcast.operators.reshape import union_all
from loadcast.operators.series import Series
from loadcast.operators.splits import split_counts
from loadcast.session import materialise, scratch_path
from loadcast.store.tables import Ledger


@dataclass(frozen=True)
class TrainingOptions:
    search_trials: int = 0
    n_splits: int = 4
    status: str = "Development"
    params: boosted.Params = boosted.Params()
    space: dict | None = None
    parallel: int = 4
    search_parallel: int = 2
    search_limit_s: float | None = None


def by_region(split: DataFrame) -> DataFrame:
    """Write the training rows once, laid out by region.

    Each regional fit then reads its own partition, instead of filtering or recomputing the
    whole feature plan once per region and boosting round.
    """
    spark = split.sparkSession
    path = scratch_path(spark, "training")
    split.write.partitionBy("region").parquet(path)
    return spark.read.parquet(path).select(*split.columns)


def train_regions(
    split: DataFrame,
    regions: list[str],
    s: Series,
    options: TrainingOptions = TrainingOptions(),
    failures: dict[str, str] | None = None,
    searches: dict[str, DataFrame] | None = None,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every region; returns errors by (region, split, model) and the fitted models.

    The requested regions are a short fixed list; all row work is distributed, and a few regions
    are fitted at a time.  A region that cannot be fitted (no rows, say) does not stop the others:
    with ``failures`` its message goes there, otherwise it is raised after the others are done.
    ``searches`` receives the scores of each region's parameter search.
    """
    rows = by_region(split)

    def one(region: str) -> PipelineModel:
        train = rows.filter((F.col("region") == region) & (F.col("split") == "train")).persist()
        try:
            params = options.params
            if options.search_trials:
                drawn = boosted.draw_params(options.search_trials, params.seed, options.space)
                params, scores = boosted.search(
                    train, drawn, s, options.n_splits, options.search_parallel, options.search_limit_s
                )
                if searches is not None:
                    searches[region] = scores
            return boosted.fit(train, params)
        finally:
            train.unpersist()

    models, failed = {}, {}
    with ThreadPoolExecutor(max(1, options.parallel)) as pool:
        for region, job in [(r, pool.submit(one, r)) for r in regions]:
            try:
                models[region] = job.result()
            except Exception as failure:
                failed[region] = failure
    if failures is not None:
        failures.update({r: str(f).splitlines()[0] for r, f in failed.items()})
    elif failed:
        raise RuntimeError(f"not fitted: {sorted(failed)}") from next(iter(failed.values()))
    if not models:
        empty = "region string, split string, model string, mae double"
        return split.sparkSession.createDataFrame([], empty), models
    scored = [boosted.predict(m, rows.filter(F.col("region") == r)) for r, m in models.items()]
    errors = evaluate.mae_by(
        evaluate.persistence(union_all(scored).withColumnRenamed("prediction", "_model")),
        ["region", "split"],
        "target",
        {"baseline": "prediction", "model": "_model"},
    )
    return errors, models


def register_better(
    errors: DataFrame,
    models: dict[str, PipelineModel],
    ledger: Ledger,
    run_id: str,
    version: str,
    options: TrainingOptions = TrainingOptions(),
) -> list[str]:
    """Save every model, log its errors, register those that beat the baseline on test rows."""
    tuned = options.search_trials > 0
    errors = materialise(errors, "errors")
    # One row per requested region.
    winners = sorted(
        row["region"]
        for row in evaluate.registration_gate(errors.filter("split = 'test'")).collect()
    )
    name = {r: f"{r}_gbt_model_{'tuned' if tuned else 'no_tuning'}" for r in models}
    path = {r: f"{ledger.root}/artefacts/{name[r]}/{version}" for r in models}
    for region, model in models.items():
        model.write().overwrite().save(path[region])
    ledger.register(
        [
            (name[r], r, tuned, version, options.status, run_id, path[r])
            for r in winners
        ]
    )
    ledger.log_metrics(
        errors.select(
            F.lit(run_id).alias("run_id"),
            "region",
            F.concat_ws("_", F.lit("mae"), "model", "split").alias("name"),
            F.col("mae").cast("string").alias("value"),
        )
    )
    return winners


def describe(split: DataFrame) -> DataFrame:
    """Rows and time extent per region and part, as logged with a run."""
    extent = split.groupBy("region", "split").agg(
        F.min("timestamp_ms").alias("first_ms"), F.max("timestamp_ms").alias("last_ms")
    )
    return split_counts(split).join(extent, ["region", "split"])




def log_searches(searches: dict[str, DataFrame], ledger: Ledger, run_id: str) -> None:
    """Mean error and status of every candidate of every region's search."""
    if not searches:
        return
    outcome = union_all(list(searches.values())).groupBy("region", "params_id").agg(
        F.max("status").alias("status"), F.avg("mae").alias("mean_mae")
    )
    values = {"search_status": F.col("status"), "search_mae": F.col("mean_mae").cast("string")}
    entries = [
        F.struct(F.concat_ws("_", F.lit(name), "params_id").alias("name"), value.alias("value"))
        for name, value in values.items()
    ]
    logged = outcome.select("region", F.explode(F.array(*entries)).alias("_e"))
    logged = logged.where("_e.value IS NOT NULL")
    ledger.log_metrics(logged.select(F.lit(run_id).alias("run_id"), "region", "_e.*"))


def log_shapes(split: DataFrame, ledger: Ledger, run_id: str) -> None:
    """Rows and time extent of every region and part, as parameters of the run."""
    values = {"rows": "n_rows", "first_ms": "first_ms", "last_ms": "last_ms"}
    entries = [
        F.struct(
            F.concat_ws("_", F.lit(name), "split").alias("name"),
            F.col(column).cast("string").alias("value"),
        )
        for name, column in values.items()
    ]
    shapes = describe(split).select("region", F.explode(F.array(*entries)).alias("_e"))
    ledger.log_metrics(shapes.select(F.lit(run_id).alias("run_id"), "region", "_e.*"))
