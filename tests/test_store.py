"""Feature tables survive replays and crashes; views join at a point in time."""

import pytest

from loadcast.operators.ranges import TimeRange
from loadcast.store import tables
from loadcast.store.tables import FeatureStore, FeatureTable, Ledger, ViewMeta
from tests.helpers import HOUR, START, demand_frame, series


def _content(table):
    return {(r["region"], r["timestamp_ms"]): r["demand"] for r in table.read().collect()}


def _table(spark, folder, name="demand"):
    return FeatureTable.get_or_create(spark, folder, name, 1, "region", "timestamp_ms")


def test_keys_come_from_a_comma_list_and_are_stored(spark, folder):
    made = FeatureTable.get_or_create(spark, folder, "t", 3, "region , timestamp_ms")
    again = FeatureTable.get_or_create(spark, folder, "t", 3, "other")
    assert made.keys == again.keys == ["region", "timestamp_ms"]


def test_upsert_twice_equals_once(spark, folder):
    rows = series("a", 60) + series("b", 10)
    table = _table(spark, folder)
    table.upsert(demand_frame(spark, rows), "0")
    first = _content(table)
    table.upsert(demand_frame(spark, rows), "1")
    assert _content(table) == first == {(r, t): v for r, t, v in rows}


def test_late_correction_leaves_other_rows(spark, folder):
    rows = series("a", 24 * 5)
    table = _table(spark, folder)
    table.upsert(demand_frame(spark, rows), "0")
    fixes = [("a", START + 3 * HOUR, -1), ("a", START + 50 * HOUR, -2), ("a", START + 500 * HOUR, -3)]
    table.upsert(demand_frame(spark, fixes), "1")
    want = {(r, t): v for r, t, v in [*rows, *fixes]}
    assert _content(table) == want


def test_a_done_batch_is_skipped(spark, folder):
    table = _table(spark, folder)
    table.upsert(demand_frame(spark, [("a", START, 1)]), "0")
    table.upsert(demand_frame(spark, [("a", START, 99)]), "0")
    assert _content(table) == {("a", START): 1}


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["_merged", "_summarise", "_publish", "mark"])
def test_a_crash_between_any_two_steps(spark, folder, monkeypatch, step):
    """The last version stays as it is; the replay has one effect, before and after the publish."""
    table = _table(spark, folder)
    table.upsert(demand_frame(spark, [("a", START, 1), ("b", START, 5)]), "0")

    def crash(*args, **kwargs):
        raise Crash

    with monkeypatch.context() as broken:
        if step == "mark":
            create = tables.create_text
            broken.setattr(
                tables, "create_text", lambda s, p, t: crash() if "/done/" in p else create(s, p, t)
            )
        else:
            broken.setattr(FeatureTable, step, crash)
        with pytest.raises(Crash):
            table.upsert(demand_frame(spark, [("a", START, 2), ("c", START + 50 * HOUR, 6)]), "1")
    published = step == "mark"
    after = {("a", START): 2, ("b", START): 5, ("c", START + 50 * HOUR): 6}
    assert _content(table) == (after if published else {("a", START): 1, ("b", START): 5})
    again = FeatureTable.get(spark, folder, "demand", 1)
    # A replay after the publish is skipped, so its content doesn't count.
    value = 77 if published else 2
    again.upsert(demand_frame(spark, [("a", START, value), ("c", START + 50 * HOUR, 6)]), "1")
    assert _content(table) == after
    assert again.manifest().number == 2


def test_a_reader_keeps_its_version_during_a_publish(spark, folder):
    table = _table(spark, folder)
    rows = series("a", 60)
    table.upsert(demand_frame(spark, rows), "0")
    reading = table.read()
    table.upsert(demand_frame(spark, [(r, t, -v) for r, t, v in rows]), "1")
    assert {(r["timestamp_ms"], r["demand"]) for r in reading.collect()} == {(t, v) for _, t, v in rows}
    assert {r["demand"] for r in table.read().collect()} == {-v for _, _, v in rows}
    assert {r["demand"] for r in table.read(number=1).collect()} == {v for _, _, v in rows}
    assert [tuple(r) for r in table.versions().orderBy("number").collect()] == [
        (0, None, 0), (1, "0", 3), (2, "1", 3),
    ]


def test_of_two_writers_one_publishes(spark, folder, monkeypatch):
    table = _table(spark, folder)
    table.upsert(demand_frame(spark, [("a", START, 1)]), "0")
    other = FeatureTable.get(spark, folder, "demand", 1)
    stale = table.manifest()
    other.upsert(demand_frame(spark, [("b", START, 2)]), "other")
    monkeypatch.setattr(table, "manifest", lambda number=None: stale)
    with pytest.raises(tables.PublishConflict):
        table.upsert(demand_frame(spark, [("c", START, 3)]), "mine")
    monkeypatch.undo()
    table.upsert(demand_frame(spark, [("c", START, 3)]), "mine")
    assert _content(table) == {("a", START): 1, ("b", START): 2, ("c", START): 3}


def test_expired_versions_free_their_folders(spark, folder):
    table = _table(spark, folder)
    table.upsert(demand_frame(spark, series("a", 48)), "0")
    table.upsert(demand_frame(spark, [("a", START, 1)]), "1")
    assert table.expire(keep=2) == 0
    assert table.expire() == 2  # the first date's data and summary
    assert table.read().count() == 48 and table.manifest().number == 2
    assert FeatureTable.get(spark, folder, "demand", 1).keys == ["region", "timestamp_ms"]


def test_summary_follows_upserts(spark, folder):
    table = _table(spark, folder)
    rows = series("a", 30) + [("b", START, None)]
    table.upsert(demand_frame(spark, rows), "0")
    table.upsert(demand_frame(spark, [("a", START + 23 * HOUR, None), ("b", START + HOUR, 4)]), "1")
    got = {
        (r["region"], str(r["event_date"])): (r["_rows"], r["_counts"]["demand"], r["_last"]["demand"])
        for r in table.summary().collect()
    }
    assert got == {
        ("a", "2024-01-01"): (24, 23, None),
        ("a", "2024-01-02"): (6, 6, rows[29][2]),
        ("b", "2024-01-01"): (2, 1, 4),
    }


def test_a_view_range_reads_its_own_dates_and_the_summary(spark, folder):
    left, right = _table(spark, folder), _table(spark, folder, "weather")
    rows = series("a", 24 * 20) + series("b", 24 * 20, seed=2)
    left.upsert(demand_frame(spark, rows), "0")
    # Of a: every 50th hour; of b: the first day only.
    kept = [r for k, r in enumerate(rows[: 24 * 20]) if k % 50 == 0] + rows[24 * 20 : 24 * 21]
    right.upsert(demand_frame(spark, kept), "0")
    store = FeatureStore(spark, folder)
    window = TimeRange(START + 250 * HOUR + 1, START + 300 * HOUR)
    for tolerance in (None, 30 * HOUR):
        view = ViewMeta(f"v{tolerance}", 1, "demand", 1, "weather", 1, "w_", tolerance)
        found = store.read_view(store.get_or_create_view(view), window)
        for row in found.collect():
            past = [
                (t, v) for r, t, v in kept
                if r == row["region"] and t <= row["timestamp_ms"]
                and (tolerance is None or t >= row["timestamp_ms"] - tolerance)
            ]
            want = max(past) if past else (None, None)
            assert (row["w_timestamp_ms"], row["w_demand"]) == want
        files = {f.split("event_date=")[1][:10] for f in found.inputFiles() if "/data/" in f}
        assert files == {"2024-01-11", "2024-01-12", "2024-01-13"}


def test_narrower_and_wider_batches_keep_all_columns(spark, folder):
    table = _table(spark, folder)
    kinds = "region string, timestamp_ms long, demand long, extra string"
    table.upsert(spark.createDataFrame([("a", START, 1, "x"), ("a", START + HOUR, 2, "y")], kinds), "0")
    table.upsert(demand_frame(spark, [("a", START, 10), ("b", START, 11)]), "1")
    wide = spark.createDataFrame([("a", START + HOUR, 20, 7)], "region string, timestamp_ms long, demand int, more int")
    table.upsert(wide, "2")
    got = {(r["region"], r["timestamp_ms"] - START): (r["demand"], r["extra"], r["more"]) for r in table.read().collect()}
    assert got == {("a", 0): (10, "x", None), ("b", 0): (11, None, None), ("a", HOUR): (20, "y", 7)}


def test_a_row_without_event_time_is_refused(spark, folder):
    table = _table(spark, folder)
    table.upsert(demand_frame(spark, [("a", START, 1)]), "0")
    with pytest.raises(Exception, match="has no timestamp_ms"):
        table.upsert(demand_frame(spark, [("a", None, 2)]), "1")
    assert _content(table) == {("a", START): 1}


def test_views_see_rows_before_1970(spark, folder):
    _table(spark, folder).upsert(demand_frame(spark, [("a", -HOUR, 1), ("a", HOUR, 2)]), "0")
    old = spark.createDataFrame([("a", -500 * HOUR, 1.5)], "region string, timestamp_ms long, temperature double")
    FeatureTable.get_or_create(spark, folder, "weather", 1, "region", "timestamp_ms").upsert(old, "0")
    view = FeatureStore(spark, folder).get_or_create_view(ViewMeta("v", 1, "demand", 1, "weather", 1))
    rows = FeatureStore(spark, folder).read_view(view, TimeRange(-2 * HOUR, 2 * HOUR)).collect()
    assert [r["weather_temperature"] for r in rows] == [1.5, 1.5]


def test_order_column_decides_inside_a_batch(spark, folder):
    table = _table(spark, folder)
    batch = spark.createDataFrame(
        [("a", START, 5, 1), ("a", START, 3, 2)], "region string, timestamp_ms long, demand long, seq long")
    table.upsert(batch, "0", order_by=["seq"])
    assert _content(table) == {("a", START): 3}


def test_time_range_prunes_dates(spark, folder):
    table = _table(spark, folder)
    table.upsert(demand_frame(spark, series("a", 24 * 6)), "0")
    window = TimeRange(START + 30 * HOUR, START + 40 * HOUR)
    got = table.read(window)
    assert got.count() == 11
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_views_are_named_and_versioned(spark, folder):
    _table(spark, folder).upsert(demand_frame(spark, series("a", 50)), "0")
    weather = FeatureTable.get_or_create(spark, folder, "weather", 1, "region", "timestamp_ms")
    weather.upsert(spark.createDataFrame([("a", START + 10 * HOUR, 1.5)],
                                         "region string, timestamp_ms long, temperature double"), "0")
    store = FeatureStore(spark, folder)
    assert store.list_views().count() == 0
    view = store.get_or_create_view(ViewMeta("v", 1, "demand", 1, "weather", 1))
    assert store.get_or_create_view(ViewMeta("v", 1, "other", 9, "weather", 1)) == view
    store.get_or_create_view(ViewMeta("v", 2, "demand", 1, "weather", 1))
    assert sorted(r["version"] for r in store.list_views("v").collect()) == [1, 2]
    rows = store.read_view(view, TimeRange(START + 5 * HOUR, START + 30 * HOUR)).collect()
    assert len(rows) == 26
    assert all((r["weather_temperature"] == 1.5) == (r["timestamp_ms"] >= START + 10 * HOUR) for r in rows)


def test_ledger(spark, folder):
    ledger = Ledger(spark, folder)
    assert ledger.models().count() == 0 and ledger.runs().count() == 0
    ledger.log_parameters("r1", {"days_back": 10, "status": "Staging"})
    ledger.register([("n", "a", False, "1.0.0", "Staging", "r1", "/x")])
    assert {r["name"]: r["value"] for r in ledger.runs().collect()} == {"days_back": "10", "status": "Staging"}
    assert ledger.models().first()["path"] == "/x"
