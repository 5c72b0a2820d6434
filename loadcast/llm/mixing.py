"""Mixing sources to target weights with weighted sampling without replacement.

Every document draws an exponential key ``-ln(u) / quality`` (Efraimidis and Spirakis): in
ascending order of key, a prefix of a source is a weighted sample without replacement.  A
source's target is met by complete epochs first; the rest is the prefix of its documents whose
sizes add up to it.  ``u`` follows from the doc_id and a seed, so reruns agree.

The prefix sums never put a source into one task.  Keys fall into bins of about ``BIN_ROWS``
rows by a monotone map of the key (quality lies in a fixed interval, which bounds how uneven
bins can be); sums per source and bin are combined before the shuffle and give each bin its
offset.  Only narrow rows are shuffled: no texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_QUALITY = 0.25
BIN_ROWS = 1000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def symbol_quality(text: str = "text") -> Column:
    """1 for a text without symbols, down to ``LEAST_QUALITY`` where a tenth are symbols."""
    length = F.length(text)
    symbols = length - F.length(F.translate(F.col(text), SYMBOLS, ""))
    share = F.least(F.lit(1.0), 10.0 * symbols / F.greatest(length, F.lit(1)))
    return F.coalesce(1.0 - (1.0 - LEAST_QUALITY) * share, F.lit(1.0))


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on key and seed only."""
    text = F.concat(F.lit(f"{seed}-"), F.coalesce(key.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / float(2**48)


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, limit: int) -> DataFrame:
    """Per source: ``sid, source, n_rows, source_size, target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times
    all sizes; a target stops at ``limit`` times the source's size and the excess goes to the
    others by weight.  That is a water level: sources are capped in order of
    ``limit * size / weight`` until the level of the rest reaches none of their caps.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")
    )
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("sid", F.row_number().over(named) - 1)
    turn = F.element_at(F.array(*map(F.lit, weights)), F.col("sid") % len(weights) + 1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy("cap_level", "sid")
    ranked = (
        ranked.withColumn("weight", turn.cast("double"))
        .withColumn("cap", F.lit(limit) * F.col("source_size"))
        .withColumn("cap_level", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped", F.sum("cap").over(by_cap) - F.col("cap"))
        .withColumn(
            "open_weight",
            F.sum("weight").over(everything) - F.sum("weight").over(by_cap) + F.col("weight"),
        )
        .withColumn("level", (F.lit(share) * F.col("total") - F.col("capped")) / F.col("open_weight"))
        .withColumn("turn", F.row_number().over(by_cap))
    )
    settled = F.when(F.col("level") <= F.col("cap_level"), F.col("turn"))
    level = F.min_by("level", settled).over(everything)
    share_of = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    target = F.coalesce(share_of, F.col("cap").cast("double"))
    return ranked.select("sid", "source", "n_rows", "source_size", target.alias("target"))


def mixture(
    docs: DataFrame,
    quality: Column | None = None,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    limit: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for each row of
    ``docs(doc_id, text, source)``.

    ``taken`` counts words, repeats included: complete epochs, then the prefix by key, of which
    the last document gives only the words still missing; a source takes ``floor(target)`` words.
    ``copies`` is the same in whole documents: the last one counts if at least half of it fits.
    ``quality`` is clamped to 0.25..1 (null: 1).  Null or blank texts have size 0; a null source
    is a source of its own, the last one; rows that repeat a doc_id are rows of their own.  With
    all sizes 0 the targets are 0.  Other columns are ignored; an empty table gives no rows.
    """
    quality = symbol_quality() if quality is None else quality
    weight = F.greatest(F.lit(LEAST_QUALITY), F.least(F.lit(1.0), F.coalesce(quality, F.lit(1.0))))
    sized = materialise(
        docs.select("doc_id", "source", word_count().alias("size"), weight.alias("quality")),
        "sized",
    )
    aims = materialise(targets(sized, weights, share, limit), "targets")
    key = -F.ln(uniform(F.col("doc_id"), seed)) / F.col("quality")
    bins = F.floor(F.col("n_rows") / BIN_ROWS) + 1
    binned = sized.join(aims.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")))
    binned = binned.withColumn("es_key", key).withColumn(
        "bin", F.floor(bins * (1.0 - F.exp(-LEAST_QUALITY * F.col("es_key"))))
    )
    until = Window.partitionBy("sid").orderBy("bin")
    offsets = (
        binned.groupBy("sid", "bin")
        .agg(F.sum("size").alias("in_bin"))
        .select("sid", "bin", (F.sum("in_bin").over(until) - F.col("in_bin")).alias("offset"))
    )
    in_bin = Window.partitionBy("sid", "bin").orderBy("es_key", "doc_id", "size")
    in_bin = in_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = binned.withColumn("upto", F.sum("size").over(in_bin)).join(offsets, ["sid", "bin"])
    budget = F.floor(F.col("target") + 1e-6).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - epochs * F.col("source_size")
    left = left - (F.col("offset") + F.col("upto") - F.col("size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    whole = (part * 2 >= F.col("size")) & (F.col("size") > 0)
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
        (epochs + whole.cast("int")).cast("int").alias("copies"),
        "source",
    )


MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         coalesce(1.0::DOUBLE - 0.75::DOUBLE * least(1.0::DOUBLE, 10.0::DOUBLE
           * (length(text) - length(translate(text, '{SYMBOLS}', ''))) / greatest(length(text), 1)),
           1.0::DOUBLE) AS quality
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM per_source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][sid % 3 + 1]::DOUBLE AS weight, 2 * source_size AS cap FROM ranked),
levels AS (
  SELECT *, cap / weight AS cap_level,
         (1.5::DOUBLE * sum(source_size) OVER ()
           - (sum(cap) OVER (ORDER BY cap / weight, sid) - cap))::DOUBLE
         / (sum(weight) OVER () - sum(weight) OVER (ORDER BY cap / weight, sid) + weight) AS level,
         row_number() OVER (ORDER BY cap / weight, sid) AS turn
  FROM weighed),
final AS (
  SELECT arg_min(level, turn) AS level FROM levels WHERE level <= cap_level),
aims AS (
  SELECT l.source, l.source_size,
         coalesce(least(l.cap::DOUBLE, f.level * l.weight), l.cap::DOUBLE) AS target
  FROM levels l LEFT JOIN final f ON true),
plan AS (
  SELECT *, floor(target + 1e-6)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(target + 1e-6)::BIGINT // source_size ELSE 0 END AS epochs
  FROM aims),
keyed AS (
  SELECT s.*, p.source_size, p.target, p.epochs, p.budget - p.epochs * p.source_size AS rest,
         -ln((('0x' || substr(md5('mix-' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT
           + 0.5::DOUBLE) / 281474976710656.0::DOUBLE) / s.quality AS es_key
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY es_key, doc_id, size
                            ROWS UNBOUNDED PRECEDING) - size AS before
  FROM keyed)
SELECT doc_id, size, source_size, round(target, 3) AS target,
       (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM placed
"""
