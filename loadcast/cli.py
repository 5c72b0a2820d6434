"""Arguments and session of the spark-submit jobs."""

from __future__ import annotations

import argparse
import shutil
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from loadcast import dims
from loadcast.operators.quality import require_valid
from loadcast.session import build_session


def session(app_name: str) -> SparkSession:
    """Session whose Python workers find this package, wherever the job was started."""
    spark = build_session(app_name)
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="loadcast-package-")
    archive = shutil.make_archive(f"{folder}/loadcast", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    return spark


def parser(description: str) -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=description)
    out.add_argument("--run-id", required=True, help="suffix of topics, checkpoints and batches")
    out.add_argument("--mode", choices=["live", "historical"], default="historical")
    out.add_argument("--regions", default=",".join(dims.REGION_CITIES))
    out.add_argument("--as-of-ms", type=int, default=int(time.time() * 1000))
    out.add_argument("--state-partitions", type=int, help="partitions of keyed stream state")
    return out


def regions(args) -> list[str]:
    return require_valid([r.strip() for r in args.regions.split(",")], dims.VALID_REGIONS)


def add_topic(p: argparse.ArgumentParser, name: str) -> None:
    p.add_argument(f"--{name}", required=True, help="topic name, or a folder for files")
    if not any(a.dest == "brokers" for a in p._actions):
        p.add_argument("--brokers", help="kafka brokers; without them topics are folders")


def table_name(args, name: str) -> str:
    """Historical runs keep to tables of their own."""
    return f"{name}_{args.run_id}" if args.mode == "historical" else name


def topic_kind(args) -> str:
    return "kafka" if args.brokers else "files"


def source_options(args, name: str) -> dict[str, str]:
    if args.brokers:
        return {"kafka.bootstrap.servers": args.brokers, "subscribe": f"{name}_{args.run_id}"}
    return {"path": f"{name}_{args.run_id}"}


def sink_options(args, name: str) -> dict[str, str]:
    if args.brokers:
        return {"kafka.bootstrap.servers": args.brokers, "topic": f"{name}_{args.run_id}"}
    return {"path": f"{name}_{args.run_id}"}
