"""Feature view to regional models, errors and registrations."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from loadcast import cli as common  # noqa: E402
from loadcast.functions.time import DAY_MS  # noqa: E402
from loadcast.models import boosted  # noqa: E402
from loadcast.operators import joins  # noqa: E402
from loadcast.operators.ranges import TimeRange  # noqa: E402
from loadcast.operators.series import Series  # noqa: E402
from loadcast.plans import features, scoring, training  # noqa: E402
from loadcast.session import materialise  # noqa: E402
from loadcast.sources.exports import write_csv  # noqa: E402
from loadcast.store.tables import FeatureStore, Ledger, ViewMeta  # noqa: E402


def main() -> None:
    p = common.parser(__doc__)
    p.add_argument("--store", required=True)
    p.add_argument("--view", default="load_view")
    p.add_argument("--view-version", type=int, default=1)
    p.add_argument("--demand", default="demand")
    p.add_argument("--weather", default="weather")
    p.add_argument("--days-back", type=int, default=365)
    p.add_argument("--search-trials", type=int, default=0)
    p.add_argument("--search-parallel", type=int, default=2, help="candidates fitted at a time")
    p.add_argument("--search-limit-s", type=float, help="seconds after which a candidate is given up")
    p.add_argument("--max-iter", type=int, default=boosted.Params.maxIter)
    p.add_argument("--n-splits", type=int, default=4)
    p.add_argument("--status", choices=["Development", "Staging", "Production"], default="Development")
    p.add_argument("--version", default="1.0.0")
    p.add_argument("--debug-path", help="also export training rows and test predictions as CSV")
    args = p.parse_args()
    wanted = common.regions(args)
    spark = common.session("train")
    store, ledger, series = FeatureStore(spark, args.store), Ledger(spark, args.store), Series()
    demand, weather = (common.table_name(args, n) for n in (args.demand, args.weather))
    view_name = common.table_name(args, args.view)
    meta = ViewMeta(view_name, args.view_version, demand, 1, weather, 1)
    view = store.read_view(
        store.get_or_create_view(meta),
        TimeRange(args.as_of_ms - args.days_back * DAY_MS, args.as_of_ms),
    )
    split = materialise(features.training_split(view, series), "split")
    params = boosted.Params(maxIter=args.max_iter)
    options = training.TrainingOptions(
        args.search_trials,
        args.n_splits,
        args.status,
        params,
        search_parallel=args.search_parallel,
        search_limit_s=args.search_limit_s,
    )
    ledger.log_parameters(args.run_id, vars(args))
    training.log_shapes(split, ledger, args.run_id)
    failures: dict[str, str] = {}
    searches: dict = {}
    errors, models = training.train_regions(split, wanted, series, options, failures, searches)
    training.log_searches(searches, ledger, args.run_id)
    if args.debug_path:
        write_csv(split, f"{args.debug_path}/rows")
        if models:
            rows = split.filter(F.col("split") == "test")
            actual = view.select("region", "timestamp_ms", "demand", "forecast")
            predicted = scoring.score(rows.drop("target", "split"), models)
            write_csv(joins.debug_predictions(actual, predicted), f"{args.debug_path}/predictions")
    for region, message in failures.items():
        print(f"{region}: not fitted: {message}")
    print(training.register_better(errors, models, ledger, args.run_id, args.version, options))


if __name__ == "__main__":
    main()
