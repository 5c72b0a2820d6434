"""Topic to feature table; the same job stores demand features and weather."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loadcast import cli as common  # noqa: E402
from loadcast.schemas import (  # noqa: E402
    CALENDAR_COLUMNS,
    DEMAND_RECORD,
    WEATHER_RECORD,
    with_rolling,
)
from loadcast.sources import topics  # noqa: E402
from loadcast.store.tables import FeatureTable  # noqa: E402
from loadcast.streaming import jobs  # noqa: E402


def feature_schema():
    schema = with_rolling(DEMAND_RECORD)
    kinds = {"hour_category": "string", "hour_category_num": "integer", "is_holiday": "integer"}
    for name in CALENDAR_COLUMNS:
        schema = schema.add(name, kinds.get(name, "double"))
    return schema.add("revision", "long").add("late", "boolean")


def main() -> None:
    p = common.parser(__doc__)
    p.add_argument("--record", choices=["demand", "weather"], required=True)
    p.add_argument("--store", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--version", type=int, default=1)
    p.add_argument("--primary-key", default="region,timestamp_ms")
    p.add_argument("--checkpoint", required=True)
    common.add_topic(p, "source")
    args = p.parse_args()
    spark = common.session("store-features")
    kind = common.topic_kind(args)
    table = FeatureTable.get_or_create(
        spark, args.store, common.table_name(args, args.table), args.version, args.primary_key
    )
    schema = feature_schema() if args.record == "demand" else WEATHER_RECORD
    messages = topics.read_topic(spark, common.source_options(args, args.source), kind)
    rows = topics.decode(messages, schema, "arrival").drop("event_time")
    checkpoint = f"{args.checkpoint}/{args.table}_{args.run_id}"
    jobs.to_table(rows, table, checkpoint, args.run_id, live=args.mode == "live").awaitTermination()


if __name__ == "__main__":
    main()
