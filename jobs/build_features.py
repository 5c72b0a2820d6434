"""Demand topic to feature topic (keyed state)."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loadcast import cli as common  # noqa: E402
from loadcast.session import stream_session  # noqa: E402
from loadcast.sources import topics  # noqa: E402
from loadcast.streaming import jobs  # noqa: E402


def main() -> None:
    p = common.parser(__doc__)
    p.add_argument("--checkpoint", required=True)
    common.add_topic(p, "source")
    common.add_topic(p, "target")
    args = p.parse_args()
    spark = stream_session(common.session("build-features"), args.state_partitions)
    kind = common.topic_kind(args)
    messages = topics.read_topic(spark, common.source_options(args, args.source), kind)
    stream = jobs.observed(jobs.feature_stream(messages), "features")
    checkpoint = f"{args.checkpoint}/features_{args.run_id}"
    query = jobs.to_topic(
        stream, common.sink_options(args, args.target), checkpoint, kind, live=args.mode == "live"
    )
    query.awaitTermination()
    print(jobs.progress(query))


if __name__ == "__main__":
    main()
