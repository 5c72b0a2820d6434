import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from loadcast.llm import mixing, sharding
from loadcast.llm.mixing import MIX_SQL, mixture
from loadcast.llm.sharding import shards
from tests.llm.samples import WORD, documents, frame


def arrow(df):
    return duckdb.from_arrow(df.toArrow())


@pytest.mark.parametrize("bin_rows", [1000, 3])
def test_mixture_equals_its_sql(spark, monkeypatch, bin_rows):
    monkeypatch.setattr(mixing, "BIN_ROWS", bin_rows)
    docs = frame(spark)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(MIX_SQL).fetchall()
    got = mixture(docs).select(
        "doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken"
    )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def waterfill(sizes, weights, total, limit):
    """Targets by repeated resharing of what is above the limits."""
    capped = {}
    while True:
        rest = total - sum(capped.values())
        open_ = {s: weights[s] for s in sizes if s not in capped}
        level = rest / sum(open_.values()) if open_ else 0
        over = [s for s in open_ if level * weights[s] > limit * sizes[s]]
        if not over:
            return {**capped, **{s: level * w for s, w in open_.items()}}
        capped |= {s: float(limit * sizes[s]) for s in over}


def test_targets_and_budgets(spark):
    rows = documents()
    out = mixture(frame(spark)).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    want = waterfill(sizes, weights, 1.5 * sum(sizes.values()), 2)
    taken = Counter()
    for r in out:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for source in sizes:
        assert taken[source] == int(want[source] + 1e-6)


def test_better_documents_come_first(spark):
    rows = [(k, "w " * 10 + ("#" * 50 if k % 2 else ""), "", "a" if k < 400 else "b", 0) for k in range(1200)]
    out = mixture(frame(spark, rows), weights=(1, 9)).where("source = 'a'").collect()
    good = sum(r["taken"] for r in out if r["doc_id"] % 2 == 0)
    assert good > 1.5 * sum(r["taken"] for r in out if r["doc_id"] % 2)


@pytest.mark.parametrize("bin_rows", [1000, 4])
def test_shards(spark, monkeypatch, bin_rows):
    monkeypatch.setattr(sharding, "BIN_ROWS", bin_rows)
    rows = documents()
    out = shards(frame(spark), 5).collect()
    again = shards(frame(spark).repartition(7), 5).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    want = sorted(
        (repr(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows
    )
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(5))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_every_shard_holds_the_mixture(spark):
    rows = [(k, f"t{k}", "", "big" if k % 3 else "small", 0) for k in range(1200)]
    counts = Counter((r["shard"], r["source"]) for r in shards(frame(spark, rows), 10).collect())
    assert {counts[k, "small"] for k in range(10)} <= {39, 40, 41}


def test_empty_tables(spark):
    assert mixture(frame(spark, [])).count() == 0
    assert shards(frame(spark, [])).count() == 0
    blank = [(1, None, "", "a", 0), (2, " ", "", None, 0)]
    assert {r["taken"] for r in mixture(frame(spark, blank)).collect()} == {0}
