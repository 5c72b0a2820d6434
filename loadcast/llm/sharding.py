"""Sharding by proportional stratified interleaving.

Rows of a source are ranked in a seeded shuffle; row ``r`` of ``n`` has the fractional rank
``(2 r - 1) / (2 n)``.  Sorted by fractional rank the sources interleave in proportion, so every
run of rows, and hence every shard, holds the mixture.  The sorted table is cut into shards of
equal row counts (at most one apart).

Neither ranking puts a source or the table into one task: both work in bins of about
``BIN_ROWS`` rows (hash bins within a source, bins of the fractional rank overall, which is
uniform by construction).  Bin counts, combined before the shuffle, give each bin its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.session import materialise

BIN_ROWS = 1000


def shards(docs: DataFrame, count: int = 24, seed: int = 11) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, source`` for each row of
    ``docs(doc_id, text, source)``.

    ``size`` is the UTF-8 length plus 8; ``slot`` numbers a shard's rows from 0 in order of
    fractional rank.  A null text has length and checksum 0; a null source is a source of its own;
    equal rows are ranked one after another.  Other columns are ignored; an empty table gives no
    rows.
    """
    rows = materialise(
        docs.select(
            "doc_id",
            "source",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        ),
        "rows",
    )
    per_source = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    strata = materialise(
        per_source.select(
            F.row_number().over(named).alias("sid"),
            F.col("source").alias("named"),
            "n_rows",
            F.sum("n_rows").over(everything).alias("total"),
        ),
        "strata",
    )
    draw = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("doc_id").isNull())
    drawn = rows.join(strata, F.col("source").eqNullSafe(F.col("named"))).withColumn(
        "draw", F.shiftrightunsigned(draw, 11)
    )
    bins = F.floor(F.col("n_rows") / BIN_ROWS) + 1
    drawn = drawn.withColumn("bin", F.floor(F.col("draw") / float(2**53) * bins))
    until = Window.partitionBy("sid").orderBy("bin")
    before = (
        drawn.groupBy("sid", "bin")
        .agg(F.count(F.lit(1)).alias("in_bin"))
        .select("sid", "bin", (F.sum("in_bin").over(until) - F.col("in_bin")).alias("before"))
    )
    shuffle = Window.partitionBy("sid", "bin").orderBy("draw", "doc_id", "size", "text_crc32")
    rank = F.col("place") + F.col("before")
    ranked = drawn.withColumn("place", F.row_number().over(shuffle)).join(before, ["sid", "bin"])
    ranked = materialise(
        ranked.withColumn("part", (2 * rank - 1) / (2.0 * F.col("n_rows"))).withColumn(
            "cell", F.floor(F.col("part") * (F.floor(F.col("total") / BIN_ROWS) + 1))
        ),
        "ranked",
    )
    cells = ranked.groupBy("cell").agg(F.count(F.lit(1)).alias("in_cell"))
    upto = F.sum("in_cell").over(Window.orderBy("cell"))
    cells = cells.select("cell", (upto - F.col("in_cell")).alias("first"))
    line = Window.partitionBy("cell").orderBy("part", "sid")
    position = F.col("first") + F.row_number().over(line) - 1
    placed = ranked.join(cells, "cell").withColumn("position", position)
    shard = F.expr(f"CAST(position * {count} DIV total AS INT)")
    start = F.expr(f"(CAST(shard AS BIGINT) * total + {count - 1}) DIV {count}")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("position") - start).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
