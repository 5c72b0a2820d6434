"""Splitting batches into accepted rows and a reject table."""

import pytest
from pyspark.sql import functions as F

from loadcast.session import list_names
from loadcast.store.rejects import RejectTable, judged
from loadcast.streaming import jobs

RAW = "period string, respondent string, type string, value string, seq long"
ROWS = [
    ("2024-01-01T05", "CAL", "D", "10", 0),
    ("2024-01-01T05", "CAL", "DF", None, 1),
    ("2024-01-01 05", "CAL", "D", "10", 2),
    (None, "XX", "??", "n/a", 3),
    ("2024-01-01T06", "CAL", "??", "10", 4),
    ("2024-01-01T06", "CAL", None, "10", 5),
    ("2024-01-01T06", "XX", "D", "10", 6),
    ("2024-01-01T06", None, "D", "10", 7),
    ("2024-01-01T06", "CAL", "D", "1.5x", 8),
    ("2024-01-01T06", "CAL", "D", "", 9),
    ("2024-01-01T06", "CAL", "D", "-7", 10),
]
REASONS = {
    2: "bad period", 3: "bad period", 4: "unknown type", 5: "unknown type", 6: "unknown region",
    7: "unknown region", 8: "bad number", 9: "bad number",
}


def found(table, schema):
    return sorted((r["batch"], r["seq"], r["reason"]) for r in table.read(schema).collect())


@pytest.fixture
def rows(spark):
    return judged(spark.createDataFrame(ROWS, RAW), ["CAL", "NY"])


def test_first_reason_of_every_row(rows):
    assert {r["seq"]: r["reason"] for r in rows.collect() if r["reason"]} == REASONS


def test_a_batch_counts_once(spark, rows, folder):
    raw = spark.createDataFrame([], RAW).schema
    table = RejectTable(spark, folder)
    assert found(table, raw) == []
    used = []
    keep = lambda part: used.append(sorted(r["seq"] for r in part.collect()))
    odd = "run/1 %-0"
    assert table.process(rows, odd, keep)
    assert not table.process(rows, odd, keep)
    assert used == [[0, 1, 10]]
    want = sorted((odd, seq, reason) for seq, reason in REASONS.items())
    assert found(table, raw) == want
    # Nothing rejected, nothing accepted, no rows at all.
    assert table.process(rows.where("reason IS NULL"), "good", keep)
    assert table.process(rows.where("reason IS NOT NULL AND seq = 4"), "bad", keep)
    assert table.process(rows.limit(0), "none", keep)
    assert used[1:] == [[0, 1, 10], [], []]
    assert found(table, raw) == sorted([*want, ("bad", 4, "unknown type")])


def test_a_batch_that_stops_is_done_again(spark, rows, folder):
    raw = spark.createDataFrame([], RAW).schema
    table = RejectTable(spark, folder)

    def stops(part):
        raise OSError("sink is away")

    with pytest.raises(OSError):
        table.process(rows, "b", stops)
    assert found(table, raw) == []
    assert table.process(rows, "b")
    assert len(found(table, raw)) == len(REASONS)
    # The stopped attempt lies there still, and is not read.
    assert len(list_names(spark, f"{table.base}/rows")) == 2


def test_of_two_writers_one_counts(spark, rows, folder):
    raw = spark.createDataFrame([], RAW).schema
    table = RejectTable(spark, folder)
    assert not table.process(rows, "b", lambda part: table.process(rows, "b"))
    assert len(found(table, raw)) == len(REASONS)


def test_stream_goes_on_after_a_failed_batch(spark, folder):
    frame = spark.createDataFrame(ROWS, RAW)
    table = RejectTable(spark, folder)
    calls, stored = [], {}

    def use(part, name):
        calls.append(name)
        if len(calls) == 2:
            raise OSError("sink is away")
        stored[name] = sorted(r["seq"] for r in part.collect())

    def run():
        raw = spark.readStream.schema(frame.schema).json(f"{folder}/polled")
        return jobs.split_rejects(raw, ["CAL"], table, use, f"{folder}/checkpoint", "r")

    frame.where("seq < 5").write.mode("append").json(f"{folder}/polled")
    run().awaitTermination()
    frame.where("seq >= 5").write.mode("append").json(f"{folder}/polled")
    with pytest.raises(Exception, match="sink is away"):
        run().awaitTermination()
    assert {s for _, s, _ in found(table, frame.schema)} == {2, 3, 4}
    run().awaitTermination()
    assert calls == ["r-0", "r-1", "r-1"] and stored == {"r-0": [0, 1], "r-1": [10]}
    assert [s for _, s, _ in found(table, frame.schema)] == sorted(REASONS)
    assert table.read(frame.schema).where(F.col("batch") == "r-1").count() == 5
