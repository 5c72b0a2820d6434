"""Registered queries of the subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm.collocations import COLLOCATIONS_SQL, collocations
from loadcast.llm.conversation_trie import TRIE_SQL, prefix_trie
from loadcast.llm.decontamination import find_leaks
from loadcast.llm.language import fit, identify
from loadcast.llm.line_templates import LINES_SQL, without_templates
from loadcast.llm.lm_scoring import score_texts
from loadcast.llm.mixing import MIX_SQL, mixture
from loadcast.llm.near_dedup import near_duplicates
from loadcast.llm.pii import personal_data
from loadcast.llm.quality import quality_rules
from loadcast.llm.sharding import shards
from loadcast.llm.substring_dedup import without_repeats
from loadcast.llm.tokens import token_counts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            CHECKS[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs, width=3, percent=85, halves=9, rows=2)


@query("op2_source_mix", MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixture(table(spark, sf_dir, "documents"))
    columns = ["doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken"]
    return found.select(*columns)


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op6_interleaved_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents")).drop("source")


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality_rules(table(spark, sf_dir, "documents"), labels)


@query("op9_personal_data")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).drop("clean")


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: their ``lang`` is the declaration, their source the host."""
    docs = table(spark, sf_dir, "documents")
    text, lang, source = F.col("text"), F.col("lang"), F.col("source")
    return identify(docs, fit(docs), ["doc_id"], text, declared=lang, host=source)


@query("language_id_of_pages")
def language_id_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages: declared in the markup, pointed to by the address, with the host's prior."""
    pages = table(spark, sf_dir, "pages")
    model = fit(table(spark, sf_dir, "documents"))
    declared = F.regexp_extract("html", r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2})", 1)
    visible = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return identify(
        pages, model, ["page_id"], visible, declared=declared, address=F.col("url")
    )


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    leaked = (F.size("leaked_items") > 0).alias("contaminated")
    return found.select("doc_id", leaked, "leaked_items", "leaked_share")


@query("op10_line_templates", LINES_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_templates(table(spark, sf_dir, "documents")).drop("dropped")


@query("op11_collocations", COLLOCATIONS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return collocations(docs, least=10, within_percent=50, top=2_000)


@query("op12_prefix_trie", TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_lm_scoring")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
