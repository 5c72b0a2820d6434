"""A corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm.decontamination import find_leaks
from loadcast.llm.language import fit, identify
from loadcast.llm.mixing import mixture
from loadcast.llm.near_dedup import near_duplicates
from loadcast.llm.sharding import shards
from loadcast.session import materialise, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not in ``gone``, which is written first so that its size is known."""
    return docs.join(materialise(gone.distinct(), "gone"), keys, "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a likely language go.

    ``lang`` is the declaration and ``source`` the host.  Rows that repeat a doc_id are judged
    by their own text; a rejected row without doc_id goes as well.
    """
    keyed = docs.withColumns({"_id": F.coalesce("doc_id", F.lit(-1)), "_mark": F.hash("text")})
    text, lang, source = F.col("text"), F.col("lang"), F.col("source")
    judged = identify(keyed, fit(docs), ["_id", "_mark"], text, declared=lang, host=source)
    rejected = judged.where("NOT kept").select("_id", "_mark")
    return _without(keyed, rejected, ["_id", "_mark"]).drop("_id", "_mark")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more.

    Rows that repeat the doc_id of the one that stays are one row afterwards.
    """
    judged = near_duplicates(docs, width=5, percent=80, halves=12, rows=2)
    gone = judged.where("NOT kept").select("doc_id")
    rest = _without(docs, gone, ["doc_id"])
    # Only repeated ids are affected: the rest is one row per id already.
    repeated = docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL")
    repeated = materialise(repeated.select("doc_id"), "repeated")
    once = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    single = rest.join(repeated, "doc_id", "left_anti")
    return single.unionByName(once).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("leaked_items") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its target size: a document is repeated as often as the mix takes it.

    Rows that repeat a doc_id are taken as often as the one of them that is taken most.
    """
    keyed = docs.withColumn("_id", F.coalesce("doc_id", F.lit(-1)))
    copies = mixture(docs).select(F.coalesce("doc_id", F.lit(-1)).alias("_id"), "copies")
    copies = copies.where("copies > 0").groupBy("_id").agg(F.max("copies").alias("_copies"))
    taken = keyed.join(materialise(copies, "copies"), "_id")
    repeats = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return taken.withColumn("_copy", repeats).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """24 shards that each hold the mixture: the row's shard and its place in it."""
    return shards(docs).select("doc_id", "source", "size", "text_crc32", "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

# Language models, MinHash candidates and latent retrieval have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
