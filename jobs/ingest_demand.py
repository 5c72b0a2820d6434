"""Landed demand payloads to merged readings on a keyed topic."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from loadcast import cli as common  # noqa: E402
from loadcast.dims import VALID_REGIONS  # noqa: E402
from loadcast.operators import profiles, quality, ranges, reshape  # noqa: E402
from loadcast.schemas import DEMAND_PAYLOAD  # noqa: E402
from loadcast.session import materialise, stream_session  # noqa: E402
from loadcast.sources import payloads, topics  # noqa: E402
from loadcast.store import rejects  # noqa: E402
from loadcast.streaming import jobs  # noqa: E402


def materialise_accepted(spark, raw, args):
    """The rows that can be used; the others go to the reject table, once for a run."""
    kept = []
    rows = rejects.judged(raw, VALID_REGIONS)
    table = rejects.RejectTable(spark, args.rejects)
    if not table.process(rows, args.run_id, lambda part: kept.append(materialise(part, "accepted"))):
        # This run's rejects are there already.
        return rows.where("reason IS NULL").drop("reason")
    return kept[0]


def main() -> None:
    p = common.parser(__doc__)
    p.add_argument("--payloads", required=True)
    p.add_argument("--last-n-days", type=int, default=30)
    p.add_argument("--page-rows", type=int, help="raw rows of a full page; trims it to full days")
    p.add_argument("--checkpoint", help="live mode")
    p.add_argument(
        "--rejects", help="keep unusable rows here; without it an unknown metric type fails the job"
    )
    common.add_topic(p, "topic")
    args = p.parse_args()
    wanted = common.regions(args)
    spark = stream_session(common.session("ingest-demand"), args.state_partitions)
    out, kind = common.sink_options(args, args.topic), common.topic_kind(args)

    if args.mode == "live":
        reader = spark.readStream.schema(DEMAND_PAYLOAD).options(**topics.BATCH_LIMITS["files"])
        stream = reader.json(args.payloads)
        readings = jobs.live_readings(stream).filter(F.col("region").isin(wanted))
        jobs.to_topic(readings, out, args.checkpoint, kind, live=True).awaitTermination()
        return

    window = ranges.shifted_range(args.as_of_ms, args.last_n_days)
    landed = spark.read.schema(DEMAND_PAYLOAD).json(args.payloads)
    # Of two values for one hour and type the later one wins: file time, file, place in the file.
    raw = payloads.explode_in_order(landed)
    if args.rejects:
        raw = materialise_accepted(spark, raw, args)
    typed = reshape.typed_records(raw, "seq").withColumn(
        "page", F.substring_index("seq", "|", 2)
    )
    typed = typed.filter(F.col("region").isin(wanted))
    unreadable = F.count_if(F.col("timestamp_ms").isNull()).alias("unreadable_periods")
    typed.groupBy("region").agg(F.count(F.lit(1)).alias("raw_rows"), unreadable).show(len(wanted))
    typed = reshape.known_types(typed.filter(window.contains("timestamp_ms")), strict=True)
    if args.page_rows:
        typed = quality.trim_pages(
            materialise(typed, "pages"), "region", "page", "timestamp_ms", args.page_rows
        )
    merged = reshape.merge_metrics(typed, "seq")
    merged = materialise(merged, "merged")
    topics.write_topic(merged, out, kind)
    profiles.counts_rollup(merged).show(len(wanted) + 1)
    profiles.time_extent(merged).show(len(wanted))


if __name__ == "__main__":
    main()
