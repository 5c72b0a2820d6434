"""Streams over topic files: parity with the batch windows, restarts, and change detection."""

import json
import random

import numpy as np
import pandas as pd
import pytest

from loadcast.schemas import CALENDAR_COLUMNS, DEMAND_PAYLOAD, DEMAND_RECORD, ROLLING_COLUMNS
from loadcast.session import stream_session
from loadcast.sources import topics
from loadcast.store.tables import FeatureTable
from loadcast.streaming import jobs
from loadcast.streaming.state import HISTORY, RollingProcessor, rolling_features
from loadcast.streaming.watch import TapLedger, run_until_idle
from tests.helpers import HOUR, START, assert_features, expected_rolling, series


def test_state_helper_continues_a_history():
    values = np.arange(500, dtype=float) * 3 % 97
    whole = rolling_features(np.empty(0), values)
    rest = rolling_features(values[400 - HISTORY : 400], values[400:])
    for name in ROLLING_COLUMNS:
        np.testing.assert_allclose(rest[name], whole[name][400:])


def _records(spark, rows):
    wide = [(t, f"p{t}", r, v, None, None, None) for r, t, v in rows]
    return spark.createDataFrame(wide, DEMAND_RECORD)


def test_restarts_give_the_batch_features(spark, folder):
    """Three runs from one checkpoint; regions interleaved, rows shuffled inside a batch."""
    spark = stream_session(spark, 4)
    rows = series("a", 260, gap=0.1) + series("b", 90)
    cuts = [START + 60 * HOUR, START + 250 * HOUR, 10**15]
    topic, table = f"{folder}/topic", FeatureTable.get_or_create(spark, folder, "f", 1, "region")
    low = 0
    for cut in cuts:
        part = [r for r in rows if low <= r[1] < cut]
        low = cut
        extra = [("b", part[-1][1] + 1, None)] if cut == cuts[0] else []
        topics.write_topic(_records(spark, list(reversed(part)) + extra), {"path": topic}, kind="files")
        stream = jobs.feature_stream(topics.read_topic(spark, {"path": topic}, kind="files"))
        query = jobs.to_table(stream, table, f"{folder}/checkpoint", "run")
        query.awaitTermination()
        assert sum(p["rows"] for p in jobs.progress(query)) == len(part) + len(extra)
    stored = table.read()
    assert set(CALENDAR_COLUMNS) <= set(stored.columns)
    got = stored.filter("demand IS NOT NULL").collect()
    assert_features(got, expected_rolling(rows), ROLLING_COLUMNS)
    empty = stored.filter("demand IS NULL").collect()
    assert len(empty) == 1 and empty[0]["mean_3"] is None


def test_a_second_value_for_the_newest_hour_replaces_it(spark, folder):
    spark = stream_session(spark, 4)
    rows = series("a", 5)
    table = FeatureTable.get_or_create(spark, folder, "f", 1, "region")
    fixed = [*rows[:-1], ("a", rows[-1][1], 10_000)]
    for part in (rows, [fixed[-1], ("a", rows[-1][1] + HOUR, 7)]):
        topics.write_topic(_records(spark, part), {"path": f"{folder}/topic"}, kind="files")
        stream = jobs.feature_stream(topics.read_topic(spark, {"path": f"{folder}/topic"}, kind="files"))
        jobs.to_table(stream, table, f"{folder}/checkpoint", "run").awaitTermination()
    want = expected_rolling([*fixed, ("a", rows[-1][1] + HOUR, 7)])
    assert_features(table.read().collect(), want, ROLLING_COLUMNS)


def test_late_shuffled_and_repeated_hours_give_the_batch_features(spark, folder):
    """Hours arrive in any order over many batches; wrong values are corrected later."""
    spark = stream_session(spark, 4)
    rows = series("a", 400) + series("b", 30)
    rng = random.Random(5)
    order = sorted(rows, key=lambda r: r[1] + rng.randint(0, 150) * HOUR)
    wrong = [(r, t, 1) for r, t, _ in rng.sample(order[:200], 40)]
    parts = [order[k : k + 110] for k in range(0, len(order), 110)]
    # Wrong values come before the right one of their hour.
    first = {(r, t) for r, t, _ in parts[0]}
    sent = [[w for w in wrong if (w[0], w[1]) in first] + parts[0], *parts[1:], parts[0][:30]]
    for part in sent:
        topics.write_topic(_records(spark, part).coalesce(1), {"path": f"{folder}/topic"}, kind="files")
    options = {"path": f"{folder}/topic", "maxFilesPerTrigger": "1"}
    table = FeatureTable.get_or_create(spark, folder, "f", 1, "region")
    stream = jobs.feature_stream(topics.read_topic(spark, options, kind="files"))
    query = jobs.to_table(stream, table, f"{folder}/checkpoint", "run")
    query.awaitTermination()
    assert len([p for p in jobs.progress(query) if p["rows"]]) == len(sent) > 2
    assert_features(table.read().collect(), expected_rolling(rows), ROLLING_COLUMNS)


class _Days(dict):
    """Map state in memory that counts what is written."""

    writes = 0

    def iterator(self):
        return iter(list(self.items()))

    def updateValue(self, key, value):
        self.writes += 1
        self[key] = value

    def removeKey(self, key):
        del self[key]


class _Mark:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def _processor(reach):
    state = RollingProcessor(reach)
    state._days, state._mark = _Days(), _Mark()
    return state


def _send(state, rows, n):
    return next(iter(state.handleInputRows(("a",), iter([_frame(rows, n)]), None)))


def test_hours_beyond_the_reach_are_marked():
    state, rows = _processor(30), series("a", 300)
    assert not _send(state, rows, 0)["late"].any()
    out = _send(state, [("a", START - 9 * HOUR, 5)], 1)
    assert len(out) == 1 and out["late"].all() and out["mean_3"].isna().all()
    assert out["demand"].iloc[0] == 5
    # In the state, but without all of its history: marked as well, and rows in reach follow it.
    oldest = min(lists[0][0] for lists in state._days.values())
    place = (oldest - START) // HOUR + 5
    out = _send(state, [("a", rows[place][1], 7_000)], 2)
    assert out["late"].sum() == 1 and out.loc[out["late"], "demand"].iloc[0] == 7_000
    fixed = [*rows[:place], ("a", rows[place][1], 7_000), *rows[place + 1 :]]
    want = expected_rolling(fixed)
    right = out[~out["late"]]
    assert len(right)
    assert_features(
        right.to_dict("records"), {("a", t): want["a", t] for t in right["timestamp_ms"]}, ROLLING_COLUMNS
    )


def test_a_batch_writes_the_days_it_changes():
    state, rows = _processor(100), series("a", 900)
    _send(state, rows[:800], 0)
    held = sum(len(lists[0]) for lists in state._days.values())
    assert HISTORY + 100 <= held < HISTORY + 124
    state._days.writes = 0
    _send(state, [*rows[800:805], ("a", rows[780][1], 3)], 1)
    assert state._days.writes == 2


@pytest.mark.parametrize("reach", [40])
def test_corrections_older_than_the_state_give_the_batch_features(spark, folder, reach):
    """Old hours are corrected, added and emptied, alone and together with new ones."""
    spark = stream_session(spark, 4)
    rows = series("a", 700, gap=0.02) + series("b", 400)
    wrong = [(r, t, 9 * v if k in (30, 200, 500) else v) for k, (r, t, v) in enumerate(rows)]
    added = [("a", START - 50 * HOUR, 123), ("b", START - 2 * HOUR, 77)]
    emptied = [("a", rows[350][1], None), ("b", rows[1000][1], None)]
    parts = [
        wrong[:600] + wrong[700:], wrong[600:700], [rows[30], added[0]],
        [rows[200], rows[500], emptied[0], ("a", rows[699][1] + HOUR, 55)], [added[1], emptied[1]],
    ]
    options = {"path": f"{folder}/topic", "maxFilesPerTrigger": "1"}
    table = FeatureTable.get_or_create(spark, folder, "f", 1, "region")
    for part in parts:
        topics.write_topic(_records(spark, part).coalesce(1), {"path": f"{folder}/topic"}, kind="files")
    stream = jobs.feature_stream(topics.read_topic(spark, options, kind="files"), reach)
    jobs.to_table(stream, table, f"{folder}/checkpoint", "run").awaitTermination()
    gone = {(r, t) for r, t, _ in emptied}
    whole = [r for r in rows if (r[0], r[1]) not in gone] + added + [("a", rows[699][1] + HOUR, 55)]
    stored = table.read()
    assert_features(stored.where("demand IS NOT NULL").collect(), expected_rolling(whole), ROLLING_COLUMNS)
    empty = stored.where("demand IS NULL").collect()
    assert {(r["region"], r["timestamp_ms"]) for r in empty} == gone
    assert all(r[c] is None for r in empty for c in ROLLING_COLUMNS)


def _frame(rows, n):
    return pd.DataFrame(
        [(t, f"p{t}", r, v, None, None, None, f"{n:05d}|{k:05d}") for k, (r, t, v) in enumerate(rows)],
        columns=[*DEMAND_RECORD.names, "arrival"],
    )


def test_a_failed_write_is_tried_again(spark, folder):
    spark = stream_session(spark, 4)
    rows = series("a", 5)
    topics.write_topic(_records(spark, rows), {"path": f"{folder}/topic"}, kind="files")
    table = FeatureTable.get_or_create(spark, folder, "f", 1, "region")
    upsert, calls = table.upsert, []

    def failing(*args, **kwargs):
        calls.append(args)
        if len(calls) < 3:
            raise TimeoutError("sink is away")
        upsert(*args, **kwargs)

    table.upsert = failing
    stream = jobs.feature_stream(topics.read_topic(spark, {"path": f"{folder}/topic"}, kind="files"))
    jobs.to_table(stream, table, f"{folder}/checkpoint", "run", delay_s=0.01).awaitTermination()
    assert len(calls) == 3 and table.read().count() == 5


def test_taps_of_more_batches_than_spark_remembers(spark, folder, tmp_path):
    """Small files as micro-batches of a live query, which stops when nothing more comes."""
    spark = stream_session(spark, 1)
    rows = series("a", 104)
    (tmp_path / "topic").mkdir()
    for k, (region, ts, demand) in enumerate(rows):
        value = json.dumps({"timestamp_ms": ts, "region": region, "demand": demand})
        message = {"key": region, "value": value, "offset": 0}
        (tmp_path / "topic" / f"{k:03d}.json").write_text(json.dumps(message))
    options = {"path": f"{folder}/topic", "maxFilesPerTrigger": "1"}
    messages = topics.decode(topics.read_topic(spark, options, kind="files"), DEMAND_RECORD)
    ledger = TapLedger(spark, folder)
    spark.streams.addListener(ledger)
    try:
        writer = jobs.observed(messages, "tap").writeStream.format("noop")
        query = jobs._start(writer, f"{folder}/checkpoint", live="100 milliseconds")
        run_until_idle(query, ledger, idle_s=8.0, check_s=0.5)
        assert not query.isActive
    finally:
        spark.streams.removeListener(ledger)
    taps = ledger.taps().select("batch", "values.rows", "values.newest_ms").collect()
    assert [r["rows"] for r in taps] == [1] * 104 and len({r["batch"] for r in taps}) == 104
    assert max(r["newest_ms"] for r in taps) == rows[-1][1]


def _poll(folder, n, *records):
    data = [{"period": p, "respondent": "CAL", "type": t, "value": v} for p, t, v in records]
    with open(f"{folder}/payloads/{n}.json", "w") as out:
        out.write(json.dumps({"response": {"data": data}}))


def test_live_readings_are_sent_when_they_change(spark, folder, tmp_path):
    spark = stream_session(spark, 4)
    (tmp_path / "payloads").mkdir()
    out = {"path": f"{folder}/topic"}
    polls = [
        [("2024-01-01T00", "D", "5"), ("2024-01-01T01", "D", "6"), ("2024-01-01T01", "DF", "8")],
        [("2024-01-01T00", "D", "5"), ("2024-01-01T01", "DF", "8"), ("2024-01-01T01", "D", "6")],
        [("2024-01-01T01", "D", "6"), ("2024-01-01T01", "DF", "9")],
        [("bad", "D", "6")],
    ]
    for n, records in enumerate(polls):
        _poll(folder, n, *records)
        payloads = spark.readStream.schema(DEMAND_PAYLOAD).json(f"{folder}/payloads")
        stream = jobs.observed(jobs.live_readings(payloads), "tap")
        jobs.to_topic(stream, out, f"{folder}/checkpoint", kind="files").awaitTermination()
    sent = topics.decode(topics.read_topic(spark, out, kind="files", streaming=False), DEMAND_RECORD)
    got = sorted((r["timestamp_ms"], r["demand"], r["forecast"], r["ti"]) for r in sent.collect())
    assert got == [(START + HOUR, 6, 8, None), (START + HOUR, 6, 9, None)]


def test_unknown_topic_kind(spark):
    with pytest.raises(ValueError, match="unknown topic kind"):
        topics.read_topic(spark, {}, kind="queue")
