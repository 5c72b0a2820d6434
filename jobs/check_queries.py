"""Compare every registered query with its check SQL.

    python jobs/check_queries.py [data dir] [query name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loadcast.catalog import CHECKS, QUERIES  # noqa: E402
from loadcast.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (value, math.copysign(1, value))
    if isinstance(value, (decimal.Decimal, datetime.date, datetime.datetime)):
        return type(value).__name__, str(value)
    return value


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda j: names[j])
    plain = [tuple(_plain(row[j]) for j in order) for row in rows]
    return [names[j] for j in order], sorted(plain, key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty text when the results are equal, else the first difference."""
    df = QUERIES[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    if name not in CHECKS:
        return "" if ours[1] else "no rows"
    result = con.execute(CHECKS[name])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} <> {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows <> {len(theirs[1])} rows"
    different = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if different:
        a, b = different[0]
        cells = [(c, x, y) for c, x, y in zip(ours[0], a, b) if x != y]
        return f"{len(different)} of {len(ours[1])} rows differ, first: {cells[:4]}"
    return "" if ours[1] else "equal but empty"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    master = os.environ.get("CHECK_MASTER", "local[8]")
    spark = build_session(
        "check", **{"spark.master": master, "spark.sql.shuffle.partitions": "8",
                    "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            message = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            message = f"{type(error).__name__}: {str(error)[:600]}"
            if os.environ.get("CHECK_TRACE"):
                traceback.print_exc()
        bad += bool(message)
        print(f"{'ok  ' if not message else 'FAIL'} {time.time() - start:6.2f}s {name} {message}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
