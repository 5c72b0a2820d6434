"""Chunked ordered operators against brute force, whatever the chunk and block sizes."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadcast.functions.time import DAY_MS
from loadcast.operators import joins, quality, rolling, splits
from loadcast.operators.series import Series, blocked
from loadcast.schemas import ROLLING_COLUMNS
from tests.helpers import HOUR, START, assert_features, by_region, demand_frame, expected_rolling, series

NAMES = [*ROLLING_COLUMNS, "target"]


@pytest.mark.parametrize(
    "block_rows, chunk_ms",
    [(4096, DAY_MS), (250, DAY_MS), (24, DAY_MS), (40, 7 * HOUR), (1, HOUR), (300, 30 * DAY_MS)],
)
def test_rolling_equals_plain_frames(spark, block_rows, chunk_ms):
    rows = series("hot", 700) + series("gaps", 300, gap=0.3) + series("few", 5)
    s = Series(chunk_ms=chunk_ms, block_rows=block_rows)
    got = rolling.add_rolling(demand_frame(spark, rows), s, target=True).collect()
    assert_features(got, expected_rolling(rows), NAMES)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    sizes=st.lists(st.integers(1, 220), min_size=1, max_size=3),
    gap=st.sampled_from([0.0, 0.2, 0.7]),
    block_rows=st.integers(1, 200),
)
def test_rolling_property(spark, sizes, gap, block_rows):
    rows = [r for k, n in enumerate(sizes) for r in series(f"r{k}", n, gap=gap)]
    got = rolling.add_rolling(demand_frame(spark, rows), Series(block_rows=block_rows), target=True)
    assert_features(got.collect(), expected_rolling(rows), NAMES)


def test_times_before_the_epoch(spark):
    rows = series("old", 60, start=-40 * HOUR)
    got = rolling.add_rolling(demand_frame(spark, rows), Series(block_rows=10), target=True)
    assert_features(got.collect(), expected_rolling(rows), NAMES)


@pytest.mark.parametrize("n", [1, 2, 3, 23, 24, 25, 167, 168, 169])
def test_gates(spark, n):
    rows = series("a", n)
    got = rolling.add_rolling(demand_frame(spark, rows), Series(block_rows=50)).collect()
    last = max(got, key=lambda r: r["timestamp_ms"])
    for size in (3, 24, 168):
        assert (last[f"mean_{size}"] is not None) == (n >= size)
        assert (last[f"median_{size}"] is not None) == (n >= size)
    for lag in (1, 24, 168):
        assert (last[f"lag_{lag}h"] is not None) == (n >= lag + 1)


def test_missing_demand_leaves_the_series(spark):
    rows = series("a", 5)
    holed = [(r, t, None if k == 2 else v) for k, (r, t, v) in enumerate(rows)]
    got = rolling.add_rolling(demand_frame(spark, holed), Series()).collect()
    kept = [r for r in holed if r[2] is not None]
    assert_features(got, expected_rolling(kept), ROLLING_COLUMNS)


def test_positions_cover_each_series(spark):
    rows = series("a", 333, gap=0.1) + series("b", 7)
    s = Series(block_rows=30)
    got = blocked(demand_frame(spark, rows), s, lambda w: {}, numbered=True).collect()
    for region, part in by_region(rows).items():
        mine = sorted((r["timestamp_ms"], r["_position"], r["_total"]) for r in got if r["region"] == region)
        assert mine == [(ts, p, len(part)) for p, (_, ts, _) in enumerate(part)]


def test_default_features_without_demand(spark):
    df = spark.createDataFrame([("a", 1)], "region string, timestamp_ms long")
    row = rolling.rolling_or_default(df, Series()).first()
    assert [row[c] for c in ROLLING_COLUMNS] == [0.0] * len(ROLLING_COLUMNS)


def _asof(left, right, tolerance=None):
    out = set()
    for region, ts, _ in left:
        past = [r for r in right if r[0] == region and r[1] <= ts]
        best = max(past, key=lambda r: r[1]) if past else None
        if best and tolerance is not None and ts - best[1] > tolerance:
            best = None
        out.add((region, ts, *(best[1:] if best else (None, None))))
    return out


@pytest.mark.parametrize("tolerance", [None, 3 * HOUR])
def test_asof_equals_brute_force_and_never_looks_ahead(spark, tolerance):
    rng = random.Random(5)
    left = series("hot", 300) + series("other", 40, gap=0.4) + series("alone", 4)
    right = [
        (region, ts + rng.choice([-1, 0, 1]) * HOUR // 2, rng.randint(1, 9))
        for region, ts, _ in left
        if region != "alone" and rng.random() < 0.1
    ]
    right = list({(r, t): (r, t, v) for r, t, v in right}.values())
    weather = spark.createDataFrame(right, "region string, timestamp_ms long, temperature long")
    got = joins.asof_join(demand_frame(spark, left), weather, Series(), "weather_", tolerance)
    rows = {(r[0], r[1], r["weather_timestamp_ms"], r["weather_temperature"]) for r in got.collect()}
    assert rows == _asof(left, right, tolerance)


def test_asof_takes_the_equal_row_and_a_far_past_row(spark):
    left = [("a", START, 1), ("a", START + 90 * DAY_MS, 2)]
    right = [("a", START - 30 * DAY_MS, 5), ("a", START, 6), ("a", START + 91 * DAY_MS, 7)]
    weather = spark.createDataFrame(right, "region string, timestamp_ms long, temperature long")
    got = joins.asof_join(demand_frame(spark, left), weather, Series(), "weather_").collect()
    assert [r["weather_temperature"] for r in got] == [6, 6]


def test_changes_keep_a_b_a(spark):
    values = [1, 1, 2, 2, 1] + [1] * 60 + [3]
    rows = [("a", START + k * HOUR, v) for k, v in enumerate(values)] + [("b", START, 1)]
    got = quality.changes(demand_frame(spark, rows), Series(), ["demand"]).collect()
    kept = sorted((r["region"], (r["timestamp_ms"] - START) // HOUR, r["demand"]) for r in got)
    assert kept == [("a", 0, 1), ("a", 2, 2), ("a", 4, 1), ("a", 65, 3), ("b", 0, 1)]


def test_changes_see_null_values(spark):
    rows = [("a", START + k * HOUR, v) for k, v in enumerate([None, None, 1, None])]
    got = quality.changes(demand_frame(spark, rows), Series(), ["demand"]).collect()
    assert sorted((r["timestamp_ms"] - START) // HOUR for r in got) == [0, 2, 3]


@pytest.mark.parametrize("n", [1, 4, 5, 10, 35, 199])
def test_split_floors_a_double_product(spark, n):
    rows = series("a", n)
    got = splits.chrono_split(demand_frame(spark, rows), Series(block_rows=16)).collect()
    train = [r for r in got if r["split"] == "train"]
    assert len(got) == n and len(train) == int(n * (1 - 0.2))
    if train and len(train) < n:
        assert max(r["timestamp_ms"] for r in train) < min(
            r["timestamp_ms"] for r in got if r["split"] == "test"
        )


@pytest.mark.parametrize("n", [10, 11, 57])
def test_folds_are_ordered_and_disjoint(spark, n, k=4):
    rows = series("a", n)
    got = splits.time_series_folds(demand_frame(spark, rows), Series(block_rows=9), k).collect()
    place = {ts: p for p, (_, ts, _) in enumerate(rows)}
    part = n // (k + 1)
    for fold in range(k):
        mine = {role: sorted(place[r["timestamp_ms"]] for r in got if r["fold"] == fold and r["role"] == role)
                for role in ("train", "validate")}
        start = n - (k - fold) * part
        assert mine["train"] == list(range(start))
        assert mine["validate"] == list(range(start, start + part))


@pytest.mark.parametrize("n", [1_001, 1_500, 5_000])
def test_last_n_beyond_the_group_limit(spark, n):
    rows = series("a", 2600, gap=0.1) + series("b", 1200) + series("c", 3)
    rows += [("b", START, k) for k in range(400)] + [(None, START, 1), ("c", None, 2)]
    latest = quality.last_n(demand_frame(spark, rows), Series(), n, ["demand"])
    want = []
    for key in ("a", "b", "c", None):
        part = [r for r in rows if r[0] == key]
        want += sorted(part, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))[-n:]
    got = [tuple(r) for r in latest.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert "[region#" not in "".join(x for x in plan.splitlines() if "row_number" in x and "_chunk" not in x)


def test_last_n_limits_before_the_shuffle(spark):
    rows = series("a", 400) + series("b", 3)
    latest = quality.last_n(demand_frame(spark, rows), Series(), 168)
    assert latest.groupBy("region").count().collect().__len__() == 2
    assert latest.count() == 171
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_batch_features_run_without_python_and_shuffle_the_source_once(spark):
    from loadcast.catalog import QUERIES

    df = QUERIES["feature_assembly"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "Python" not in plan and "ReusedExchange" in final
    assert final.count("FileScan") == 2  # demand and weather


def test_exploded_block_copies_do_not_survive(spark):
    rows = series("a", 500)
    got = rolling.add_means(demand_frame(spark, rows), Series(block_rows=20))
    assert got.count() == 500
    assert got.select("timestamp_ms").distinct().count() == 500
    assert set(got.columns) == {"region", "timestamp_ms", "demand", "mean_3", "mean_24", "mean_168"}
    assert got.filter(F.col("mean_168").isNotNull()).count() == 500 - 167
