"""Landed city weather payloads to regional hours on a keyed topic."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from loadcast import cli as common  # noqa: E402
from loadcast.operators import profiles, ranges, weather  # noqa: E402
from loadcast.session import materialise  # noqa: E402
from loadcast.sources import payloads, topics  # noqa: E402


def main() -> None:
    p = common.parser(__doc__)
    p.add_argument("--payloads", required=True)
    p.add_argument("--last-n-days", type=int, default=30)
    common.add_topic(p, "topic")
    args = p.parse_args()
    wanted = common.regions(args)
    spark = common.session("ingest-weather")
    window = ranges.shifted_range(args.as_of_ms, args.last_n_days)
    cities = payloads.read_weather_payloads(spark, args.payloads)
    cities = cities.filter(F.col("region").isin(wanted))
    hours = cities.filter(F.col("timestamp_ms") >= window.start_ms)
    regional = materialise(weather.regional_history(hours, F.lit(window.end_ms)), "weather")
    topics.write_topic(regional, common.sink_options(args, args.topic), common.topic_kind(args))
    profiles.counts_rollup(regional).show(len(wanted) + 1)


if __name__ == "__main__":
    main()
