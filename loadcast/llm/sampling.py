"""Samples of a bounded expected size, without a sort and without shuffling rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows (all, if there are no more): those whose key hash is low.

    The hash is uniform over 64 bits, so its limit follows from the count.  ``keys`` should tell
    rows apart: copies with one key come all or not at all.  Reruns agree.
    """
    count = df.count()
    if count <= rows:
        return df
    limit = rows * 2**64 // count - 2**63
    return df.where(F.xxhash64(*keys) < F.lit(limit))


def hashed_sample_by(df: DataFrame, rows: int, least: int, group: str, *keys: str) -> DataFrame:
    """``hashed_sample`` by ``group`` (a column without nulls, of few values).

    Groups share ``rows`` evenly; what small ones leave goes to the others.  Each has at least about
    ``least`` rows (all, if it has no more), and one in any case, at every size of the table.
    """
    key = F.xxhash64(*keys)
    found = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low")).collect()
    if sum(r["n"] for r in found) <= rows:
        return df
    left, share = rows, 0
    for k, r in enumerate(sorted(found, key=lambda r: r["n"])):
        share = max(least, left // (len(found) - k))
        left = max(0, left - min(r["n"], share))
    limits = []
    for r in found:
        limit = 2**63 - 1 if r["n"] <= share else share * 2**64 // r["n"] - 2**63
        limits += [F.lit(r[group]), F.lit(max(limit, r["low"]))]
    return df.where(key <= F.try_element_at(F.create_map(*limits), F.col(group)))
