"""One gradient-boosted regressor per region, with optional parameter search."""

from __future__ import annotations

import random
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loadcast.models.bounded import OK, run_bounded
from loadcast.operators import evaluate
from loadcast.operators.series import Series
from loadcast.operators.splits import time_series_folds

NOT_FEATURES = ("region", "target", "split", "fold", "role")


@dataclass(frozen=True)
class Params:
    """Learner settings; the names are those of the MLlib regressor."""

    maxIter: int = 100
    maxDepth: int = 6
    stepSize: float = 0.3
    subsamplingRate: float = 1.0
    featureSubsetStrategy: str = "all"
    minInstancesPerNode: int = 1
    minInfoGain: float = 0.0
    lossType: str = "squared"
    seed: int = 7

    @property
    def params_id(self) -> str:
        return "-".join(str(v) for v in self.__dict__.values())


# Search ranges of the tuned settings (fixed values).  L1/L2 leaf penalties have no MLlib
# counterpart and are left out.
SEARCH_SPACE = {
    "maxIter": (100, 1000),
    "maxDepth": (3, 10),
    "stepSize": (0.01, 0.3),
    "subsamplingRate": (0.5, 1.0),
    "featureSubsetStrategy": (0.5, 1.0),
    "minInstancesPerNode": (1, 10),
    "minInfoGain": (0.0, 5.0),
}


def draw_params(trials: int, seed: int = 7, space: dict | None = None) -> list[Params]:
    """Seeded random candidates; integer bounds give integers."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        values = {}
        for name, (low, high) in (space or SEARCH_SPACE).items():
            whole = isinstance(low, int) and isinstance(high, int)
            value = rng.randint(low, high) if whole else rng.uniform(low, high)
            values[name] = f"{value:.3f}" if name == "featureSubsetStrategy" else value
        out.append(Params(**values, seed=seed))
    return out


def feature_names(df: DataFrame) -> list[str]:
    """Every numeric column but the keys and the target; time and demand stay features."""
    numeric = ("bigint", "int", "double", "float", "smallint", "tinyint")
    return [c for c, kind in df.dtypes if c not in NOT_FEATURES and kind in numeric]


def fit(train: DataFrame, params: Params) -> PipelineModel:
    # Missing values score as NaN instead of failing; training rows have none.
    assembler = VectorAssembler(
        inputCols=feature_names(train), outputCol="features", handleInvalid="keep"
    )
    learner = GBTRegressor(labelCol="target", featuresCol="features", **params.__dict__)
    return Pipeline(stages=[assembler, learner]).fit(train)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).drop("features")


def search(
    train: DataFrame,
    candidates: list[Params],
    s: Series,
    n_splits: int = 4,
    parallel: int = 2,
    limit_s: float | None = None,
) -> tuple[Params, DataFrame]:
    """Best candidate by mean error over expanding folds, and all fold scores.

    ``train`` holds one region.  ``parallel`` candidates are fitted at a time; each fit is a
    distributed job over the fold's rows.  The scores have a ``status``: a candidate that fails or
    takes longer than ``limit_s`` leaves one row that says so, without fold and error, and is not
    chosen.  It is an error if no candidate is left.
    """
    folds = time_series_folds(train, s, n_splits).persist()

    def scores_of(params: Params) -> list:
        found = []
        for fold in range(n_splits):
            rows = folds.filter(F.col("fold") == fold)
            model = fit(rows.filter("role = 'train'"), params)
            scored = predict(model, rows.filter("role = 'validate'"))
            mae = evaluate.mae_by(scored, ["region", "fold"], "target", {"mae": "prediction"})
            # One row: a region and a fold.  Computed here, so that it counts in the limit.
            found += [(r["region"], r["fold"], r["mae"]) for r in mae.collect()]
        return found

    spark = train.sparkSession
    calls = {p.params_id: partial(scores_of, p) for p in candidates}
    try:
        outcomes = run_bounded(spark, calls, parallel, limit_s, pool="search")
    finally:
        folds.unpersist()
    good = {k: o.value for k, o in outcomes.items() if o.status == OK}
    if not any(good.values()):
        raise RuntimeError(f"no candidate was fitted: {[o.message for o in outcomes.values()]}")
    region = next(rows[0][0] for rows in good.values() if rows)
    scores = [(*row, k, OK) for k, rows in good.items() for row in rows]
    scores += [(region, None, None, k, o.status) for k, o in outcomes.items() if k not in good]
    schema = StructType([folds.schema["region"], folds.schema["fold"]])
    schema = schema.add("mae", "double").add("params_id", "string").add("status", "string")
    nullable = StructType([StructField(f.name, f.dataType, True) for f in schema])
    fold_mae = spark.createDataFrame(scores, nullable)
    ranked = evaluate.cross_validation_score(fold_mae.filter(F.col("status") == OK))
    best = evaluate.best_parameters(ranked).first()
    chosen = next(p for p in candidates if p.params_id == best["params_id"])
    return chosen, fold_mae
