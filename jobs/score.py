"""Score the latest features of all regions and write predictions, accuracy and profiles."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from loadcast import cli as common  # noqa: E402
from loadcast import dims  # noqa: E402
from loadcast.models import boosted  # noqa: E402
from loadcast.operators import evaluate, profiles, quality, ranges, reshape  # noqa: E402
from loadcast.plans import features, scoring  # noqa: E402
from loadcast.operators.series import Series  # noqa: E402
from loadcast.session import materialise  # noqa: E402
from loadcast.schemas import DEMAND_PAYLOAD  # noqa: E402
from loadcast.sources import payloads  # noqa: E402
from loadcast.store.tables import FeatureStore, Ledger  # noqa: E402


def main() -> None:
    p = common.parser(__doc__)
    p.add_argument("--store", required=True)
    p.add_argument("--payloads", required=True, help="landed recent demand payloads")
    p.add_argument("--weather", default="weather")
    p.add_argument("--hours-back", type=int, default=720)
    p.add_argument("--status", default="Production")
    p.add_argument("--output", required=True)
    args = p.parse_args()
    wanted = common.regions(args)
    spark = common.session("score")
    series = Series()
    window = ranges.day_aligned_range(args.as_of_ms, args.hours_back)
    landed = spark.read.schema(DEMAND_PAYLOAD).json(args.payloads)
    typed = reshape.typed_records(payloads.explode_in_order(landed), "seq")
    typed = reshape.known_types(typed.filter(window.contains("timestamp_ms")))
    typed = typed.filter(F.col("region").isin(wanted))
    keys = ["region", "timestamp_ms", "electricity_demand_type"]
    # Strict long to wide, scoring names, and back to the names of the features.
    wide = reshape.pivot_metrics(quality.dedupe_latest(typed, keys, "seq"))
    named = materialise(reshape.canonical_metrics(reshape.rename_metrics(wide)), "readings")
    readings = materialise(quality.trim_after_last_actual(named, series), "trimmed")
    table = common.table_name(args, args.weather)
    weather = FeatureStore(spark, args.store).table(table, 1).read(window)
    demand = readings.select("region", "timestamp_ms", "demand")
    rows = materialise(features.assemble_features(demand, weather, series), "features")
    errors: dict[str, str] = {}
    models = scoring.load_models(Ledger(spark, args.store), wanted, args.status, errors)
    requested = spark.createDataFrame([(r,) for r in wanted], "region string")
    status = scoring.region_status(rows, models, requested, errors)
    status.write.mode("overwrite").parquet(f"{args.output}/status")

    forecast = readings.select("region", "timestamp_ms", "forecast")
    predictions = materialise(scoring.prediction_table(rows, forecast, models), "predictions")
    predictions.write.mode("overwrite").parquet(f"{args.output}/predictions")
    accuracy = evaluate.accuracy(predictions, ["region"])
    evaluate.metrics_as_rows(accuracy, ["region"]).write.mode("overwrite").parquet(
        f"{args.output}/accuracy"
    )
    local = profiles.with_local_time(predictions, dims.region_zones(spark))
    profiles.hourly_profile(local).write.mode("overwrite").parquet(f"{args.output}/hourly")
    profiles.weekend_profile(local).write.mode("overwrite").parquet(f"{args.output}/weekend")
    # All features, against the prediction; a region's latest row is still open and left out.
    columns = [c for c in boosted.feature_names(predictions) if c != "prediction"]
    newest = predictions.groupBy("region").agg(F.max("timestamp_ms").alias("_newest"))
    closed = predictions.join(newest, "region").filter("timestamp_ms < _newest").drop("_newest")
    ranking = evaluate.mutual_information(closed, "region", columns, "prediction")
    ranking.write.mode("overwrite").parquet(f"{args.output}/importance")


if __name__ == "__main__":
    main()
