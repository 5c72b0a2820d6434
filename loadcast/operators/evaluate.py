"""Errors, accuracy tables, standardisation and feature ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.functions import numbers
from loadcast.operators.quality import drop_incomplete
from loadcast.session import materialise

ACCURACY = 100_000


def persistence(df: DataFrame, feature: str = "demand") -> DataFrame:
    """Baseline: the next value equals ``feature`` now."""
    if feature not in df.columns:
        raise ValueError(f"baseline feature {feature} is missing; have {df.columns}")
    return df.withColumn("prediction", F.col(feature).cast("double"))


def mae_by(df: DataFrame, keys: list[str], actual: str, predictions: dict[str, str]) -> DataFrame:
    """One row per key group and model (``model`` -> prediction column)."""
    models = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("_predicted"))
                for m, c in predictions.items()
            ]
        )
    )
    long = df.select(*keys, F.col(actual).alias("_actual"), models.alias("_m"))
    long = long.select(*keys, "_actual", "_m.*")
    mae = numbers.mean_absolute_error(F.col("_actual"), F.col("_predicted"))
    return long.groupBy(*keys, "model").agg(mae.alias("mae"))


def accuracy(
    df: DataFrame,
    keys: list[str],
    actual: str = "demand",
    model: str = "prediction",
    forecast: str = "forecast",
) -> DataFrame:
    """MAE, MSE, RMSE, MAPE and R2 of model and published forecast, side by side.

    Rows lacking any of the three values are left out first.  All measures are one
    aggregation with fixed-size buffers.
    """
    used = drop_incomplete(df.select(*keys, actual, model, forecast), [actual, model, forecast])
    truth = F.col(actual).cast("double")
    columns: list[Column] = []
    for name, predicted in (("model", F.col(model)), ("forecast", F.col(forecast))):
        p = predicted.cast("double")
        mse = numbers.mean_squared_error(truth, p)
        columns += [
            numbers.mean_absolute_error(truth, p).alias(f"{name}_mae"),
            mse.alias(f"{name}_mse"),
            F.sqrt(mse).alias(f"{name}_rmse"),
            numbers.mape(truth, p).alias(f"{name}_mape"),
            numbers.r_squared(truth, p).alias(f"{name}_r2"),
        ]
    return used.groupBy(*keys).agg(*columns) if keys else used.agg(*columns)


METRIC_LABELS = {"mae": "MAE", "mse": "MSE", "rmse": "RMSE", "mape": "MAPE", "r2": "R2"}


def metrics_as_rows(wide: DataFrame, keys: list[str]) -> DataFrame:
    """One row per metric with a column per model."""
    rows = [
        F.struct(
            F.lit(label).alias("Metric"),
            F.col(f"model_{m}").alias("Model"),
            F.col(f"forecast_{m}").alias("Forecast"),
        )
        for m, label in METRIC_LABELS.items()
    ]
    return wide.select(*keys, F.explode(F.array(*rows)).alias("_m")).select(*keys, "_m.*")


def registration_gate(mae: DataFrame, candidate: str = "model", baseline: str = "baseline"):
    """Keys whose candidate beats the baseline."""
    wide = mae.groupBy("region").agg(
        F.max(F.when(F.col("model") == candidate, F.col("mae"))).alias("mae_model"),
        F.max(F.when(F.col("model") == baseline, F.col("mae"))).alias("mae_baseline"),
    )
    return wide.filter(F.col("mae_model") < F.col("mae_baseline"))


def cross_validation_score(fold_mae: DataFrame) -> DataFrame:
    """Mean fold error per parameter set, best first within a region."""
    return fold_mae.groupBy("region", "params_id").agg(F.avg("mae").alias("mean_mae"))


def best_parameters(scores: DataFrame) -> DataFrame:
    order = F.struct("mean_mae", "params_id")
    return scores.groupBy("region").agg(
        F.min_by("params_id", order).alias("params_id"), F.min("mean_mae").alias("mean_mae")
    )


def standardize(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation per key; a constant column becomes 0."""
    stats = df.groupBy(key).agg(
        *[F.avg(c).alias(f"_avg_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_dev_{c}") for c in columns],
    )
    scaled = {
        c: (F.col(c) - F.col(f"_avg_{c}"))
        / F.when(F.col(f"_dev_{c}") > 0, F.col(f"_dev_{c}")).otherwise(F.lit(1.0))
        for c in columns
    }
    return df.join(stats, key).withColumns(scaled).select(*df.columns)


def exact_quantiles(
    df: DataFrame, group: list[str], value: str, fractions: list[float], accuracy: int = ACCURACY
) -> DataFrame:
    """(group, n, cuts): the value at rank ceil(p n) for each fraction p, exact for any n.

    A sketch gives each group's quantiles, and for each a value surely at or below it and one surely at
    or above it.  In groups of up to ``accuracy`` rows the sketch is exact.  Where there are larger
    ones, a second pass counts the rows below each such interval and the distinct values inside
    it (about 4 n / accuracy of them), and the rank picks among these.  ``df`` is read up to three times.
    """
    m, margin = len(fractions), 2 / accuracy
    ends = [max(0.0, p - margin) for p in fractions] + [min(1.0, p + margin) for p in fractions]
    at = F.array(*[F.lit(p) for p in [*fractions, *ends]])
    # A few numbers for each group.
    sketch = df.groupBy(*group).agg(
        F.count(value).alias("n"), F.percentile_approx(value, at, accuracy).alias("_at")
    )
    sketch = materialise(sketch, "quantiles")
    if (sketch.agg(F.max("n")).first()[0] or 0) <= accuracy:
        return sketch.select(*group, "n", F.slice("_at", 1, m).alias("cuts"))
    bounds = sketch.select(
        *group, "n", F.slice("_at", m + 1, m).alias("_low"), F.slice("_at", 2 * m + 1, m).alias("_high")
    )
    rows = df.select(*group, F.col(value).alias("_x")).where("_x IS NOT NULL").join(bounds, group)
    below = rows.groupBy(*group, "n").agg(
        F.array(*[F.count_if(F.col("_x") < F.col("_low")[k]) for k in range(m)]).alias("_below")
    )
    inside = F.filter(
        F.sequence(F.lit(0), F.lit(m - 1)),
        lambda k: (F.get("_low", k) <= F.col("_x")) & (F.col("_x") <= F.get("_high", k)),
    )
    values = rows.select(*group, "_x", F.explode(inside).alias("_k"))
    values = values.groupBy(*group, "_k", "_x").agg(F.count(F.lit(1)).alias("_c"))
    so_far = Window.partitionBy(*group, "_k").orderBy("_x")
    values = values.withColumn("_sum", F.sum("_c").over(so_far)).join(below, group)
    wanted = F.ceil(F.get(F.array(*[F.lit(p) for p in fractions]), "_k") * F.col("n"))
    reached = values.where(F.get("_below", "_k") + F.col("_sum") >= F.greatest(wanted, F.lit(1)))
    found = reached.groupBy(*group, "n", "_k").agg(F.min("_x").alias("_x"))
    ordered = F.sort_array(F.collect_list(F.struct("_k", "_x")))  # one entry for each fraction
    cuts = F.transform(ordered, lambda e: e["_x"])
    return found.groupBy(*group, "n").agg(cuts.alias("cuts"))


def mutual_information(
    df: DataFrame,
    key: str,
    features: list[str],
    target: str,
    bins: int = 16,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Mutual information of each feature with the target over quantile bins, per key.

    Cut points are exact quantiles of each key and feature (an outlier does not empty the other
    bins); ``accuracy`` sets the work of finding them, not the result.  The joint
    counts have at most ``bins * bins`` cells per key and feature, so nothing grows with the rows.
    The score does not change under scaling of the features.
    """
    pair = F.explode(
        F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x"))
                for f in features
            ]
        )
    )
    long = (
        df.select(key, F.col(target).cast("double").alias("y"), pair.alias("_p"))
        .select(key, "y", "_p.*")
        .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    )
    group = [key, "feature"]
    at = [k / bins for k in range(1, bins)]
    xs, ys = (
        exact_quantiles(long, group, v, at, accuracy).select(*group, F.col("cuts").alias(f"{v}s"))
        for v in ("x", "y")
    )
    bounds = xs.join(ys, group)

    def bin_of(value: str, cuts: str) -> Column:
        return F.size(F.filter(cuts, lambda cut: cut < F.col(value)))

    joint = (
        long.join(bounds, group)
        .groupBy(*group, bin_of("x", "xs").alias("bx"), bin_of("y", "ys").alias("by"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # From here on there are at most bins * bins rows per key and feature.
    nx = joint.groupBy(*group, "bx").agg(F.sum("n").alias("nx"))
    ny = joint.groupBy(*group, "by").agg(F.sum("n").alias("ny"))
    total = joint.groupBy(*group).agg(F.sum("n").alias("nt"))
    cells = joint.join(nx, [*group, "bx"]).join(ny, [*group, "by"]).join(total, group)
    n, t = F.col("n").cast("double"), F.col("nt").cast("double")
    term = n / t * F.ln(n * t / (F.col("nx").cast("double") * F.col("ny").cast("double")))
    return cells.groupBy(*group).agg(F.sum(term).alias("importance"))
