"""Ordered operators over keyed series that may be very unevenly sized.

A window partitioned by the series key alone runs each series in one task, so a key with a
third of all rows decides the run time.  Everything here works on *chunks* instead: the part
of a series inside one time bucket.  Event times are unique within a series at some grain,
so the chunk width bounds the rows of a chunk (24 for hourly rows and one-day chunks), and
chunks spread over the cluster whatever the key distribution.

What a chunk needs from its past travels through the *chunk index*, an aggregate with one
row per (key, chunk):

* ``blocked``  - row frames (rolling, lag, lead, row numbers).  Whole chunks are packed into
  blocks of about ``block_rows`` rows and the chunks just before a block are copied into it.
* ``carried``  - running state (last value so far, previous row).  The state at the end of
  the earlier chunks is added to each chunk as one extra row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loadcast.functions.time import DAY_MS, bucket_of


@dataclass(frozen=True)
class Series:
    """Names the key and event time of a series, and how it is cut."""

    key: str = "region"
    ts: str = "timestamp_ms"
    chunk_ms: int = DAY_MS
    block_rows: int = 4096

    @property
    def chunk(self) -> Column:
        return bucket_of(self.ts, self.chunk_ms)


def chunk_index(df: DataFrame, s: Series) -> DataFrame:
    """Rows before each chunk and in the whole series: ``_start``, ``_count``, ``_total``.

    The counts combine map-side; the windows see one row per chunk, not per input row.
    """
    counts = df.groupBy(s.key, s.chunk.alias("_chunk")).agg(F.count(F.lit(1)).alias("_count"))
    past = Window.partitionBy(s.key).orderBy("_chunk")
    before = past.rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        s.key,
        "_chunk",
        "_count",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"),
        F.sum("_count").over(Window.partitionBy(s.key)).alias("_total"),
    )


def _block_map(index: DataFrame, s: Series, back: int, ahead: bool) -> DataFrame:
    """Blocks each chunk belongs to: its own and those it is history (or the next row) of."""
    size = F.lit(s.block_rows)
    own = F.floor(F.col("_start") / size)
    # A later block starts at or after number * block_rows, so this covers every block that
    # may reach back into the chunk; copies nobody needs are dropped with the other copies.
    last = F.floor((F.col("_start") + F.col("_count") + F.lit(back - 1)) / size)
    blocks = F.sequence(own, F.greatest(own, last))
    mapped = index.withColumn("_own", own)
    if ahead:
        previous = F.lag("_own").over(Window.partitionBy(s.key).orderBy("_chunk"))
        mapped = mapped.withColumn("_previous", previous)
        lead_in = F.when(
            F.col("_previous") < F.col("_own"), F.array("_previous")
        ).otherwise(F.array().cast("array<bigint>"))
        blocks = F.concat(lead_in, blocks)
    return mapped.select(s.key, "_chunk", "_start", "_total", "_own", blocks.alias("_blocks"))


def blocked(
    df: DataFrame,
    s: Series,
    columns: Callable[[WindowSpec], dict[str, Column]],
    *,
    derived: dict[str, Column] | None = None,
    back: int = 0,
    ahead: bool = False,
    numbered: bool = False,
) -> DataFrame:
    """Add row-frame columns to ``df``, equal to a window over the whole series.

    ``columns`` maps an ordered window to columns whose frames reach at most ``back`` rows
    back, and one row ahead if ``ahead``.  ``derived`` are columns computed from those in the
    same row; window columns whose name starts with ``_`` serve them only and are dropped.
    Rows without a key or time belong to no series and are left out.  ``numbered`` adds
    ``_position`` (0-based place in the series) and ``_total`` (rows of the series).
    """
    names = df.columns
    # The join stays an outer one (outer explode, null-safe filter).  An inner join would infer
    # filters that differ between the branches, so an expensive input could not be shuffled once
    # and its exchange reused; and it could take the rows as the broadcast side, which leaves
    # the copying to the few tasks of the index.
    df = df.filter(F.col(s.key).isNotNull() & F.col(s.ts).isNotNull())
    placement = _block_map(chunk_index(df, s), s, back, ahead)
    rows = (
        df.withColumn("_chunk", s.chunk)
        .join(placement, [s.key, "_chunk"], "left")
        .withColumn("_block", F.explode_outer("_blocks"))
        # Explicit, because rows that happen to be partitioned by the key alone would satisfy
        # the window as they are, and then one task would hold a whole series.
        .repartition(s.key, "_block")
    )
    w = Window.partitionBy(s.key, "_block").orderBy(s.ts)
    out = columns(w)
    added = [c for c in [*out, *(derived or {})] if not c.startswith("_")]
    if numbered:
        # The rows of a block are consecutive, so its first row fixes all positions.
        first = F.first("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))
        out = {**out, "_position": first + F.row_number().over(w) - 1}
        added += ["_position", "_total"]
    own = rows.withColumns(out).filter(F.col("_block").eqNullSafe(F.col("_own")))
    return own.withColumns(derived or {}).select(*names, *added)


def carried(
    df: DataFrame,
    s: Series,
    state: Column,
    name: str,
    *,
    before: Callable[[Column, Column, WindowSpec], Column],
    order: list[Column] | None = None,
) -> DataFrame:
    """Add ``name``: a running value over the earlier rows of the series.

    ``state`` is what one row leaves behind (NULL leaves nothing).  ``before`` builds the
    result from (state column, is-carried-row flag, window); the row carried into a chunk
    holds the last state of all earlier chunks and sorts first.
    """
    names = df.columns
    ties = order or []
    rows = df.withColumn("_chunk", s.chunk).withColumn("_state", state)
    rank = F.when(F.col("_state").isNotNull(), F.struct(F.col(s.ts), *ties))
    ends = rows.groupBy(s.key, "_chunk").agg(F.max_by("_state", rank).alias("_end"))
    past = (
        Window.partitionBy(s.key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = ends.select(
        s.key,
        "_chunk",
        F.last("_end", ignorenulls=True).over(past).alias("_state"),
        F.lit(0).alias("_side"),
    ).filter(F.col("_state").isNotNull())
    both = rows.withColumn("_side", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(s.key, "_chunk").orderBy("_side", s.ts, *ties)
    return (
        both.repartition(s.key, "_chunk")  # as in ``blocked``
        .withColumn(name, before(F.col("_state"), F.col("_side") == 0, w))
        .filter(F.col("_side") == 1)
        .select(*names, name)
    )
