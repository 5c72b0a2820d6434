import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from jobs.check_queries import TABLES, connect
from loadcast.llm.queries import CHECKS, QUERIES
from tests.llm.samples import documents, frame, prose
from tests.llm.test_near_dedup import brute

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 11)}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(CHECKS) <= set(entry.oracle_sql())
    assert "documents" in TABLES


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_its_check(spark, name):
    result = connect(SF_DIR).execute(CHECKS[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(result.fetchall())


def test_stages_on_the_sample(spark, folder):
    item = prose(77, 40, 3000)
    rows = documents() + [(300, f"{prose(5, 30)} {item}", "en", "s1", 0), (301, "12 34 !!", "en", "s1", 0)]
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "shard":
            assert out.columns == columns
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        left[name] = docs.collect()
    blank = {0, 1, 2, 301}
    assert {r["doc_id"] for r in left["language_id"]} == {d for d, *_ in rows} - blank
    assert len(left["language_id"]) == len(rows) - len(blank)
    roots, _ = brute([r for r in rows if r[0] not in blank], 5, 80)
    kept = sorted(d for d, root in roots.items() if d == root)
    assert sorted(r["doc_id"] for r in left["near_dedup"] if r["doc_id"] is not None) == kept
    assert [r["doc_id"] for r in left["near_dedup"] if r["doc_id"] is None] == [None]
    clean = {r["doc_id"] for r in left["decontaminate"]}
    assert clean == {r["doc_id"] for r in left["near_dedup"]} - {300}
    assert {r["doc_id"] for r in left["mix_sources"]} <= clean
    assert len(left["shard"]) == len(left["mix_sources"])


def test_run_on_the_smallest_data(spark):
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["shard"] for r in out} == set(range(24))
    known = duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/documents.parquet'").fetchall()[0][0]
    assert 0 < len({r["doc_id"] for r in out}) <= known


def test_stages_on_empty_tables(spark, folder):
    frame(spark, []).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
