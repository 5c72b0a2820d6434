"""Regional models: training, search, registration and scoring."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from loadcast import dims
from loadcast.models import boosted
from loadcast.models.bounded import run_bounded
from loadcast.operators.series import Series
from loadcast.operators.splits import chrono_split
from loadcast.plans import scoring, training
from loadcast.store.tables import Ledger
from tests.helpers import HOUR, START

S = Series()


@pytest.fixture(scope="module")
def split(spark):
    """A daily wave: the hour predicts the next value, the current value alone does not."""
    rows = spark.range(0, 400).select(
        F.explode(F.array(F.lit("CAL"), F.lit("NY"))).alias("region"),
        (F.lit(START) + F.col("id") * HOUR).alias("timestamp_ms"),
        F.pmod("id", F.lit(24)).alias("hour"),
    )
    rows = rows.withColumn("demand", F.expr("cast(abs(hour - 12) * 100 as bigint)"))
    rows = rows.withColumn("target", F.expr("cast(abs(pmod(hour + 1, 24) - 12) * 100 as bigint)"))
    return chrono_split(rows, S)


def test_candidates_are_seeded_and_inside_the_ranges():
    drawn = boosted.draw_params(5, seed=3)
    assert drawn == boosted.draw_params(5, seed=3) and len({p.params_id for p in drawn}) == 5
    for p in drawn:
        assert 100 <= p.maxIter <= 1000 and 3 <= p.maxDepth <= 10 and 0.01 <= p.stepSize <= 0.3


def test_train_register_load_and_score(spark, split, folder):
    options = training.TrainingOptions(
        search_trials=1, n_splits=2, status="Production",
        space={"maxIter": (3, 3), "maxDepth": (4, 4)},
    )
    searches = {}
    errors, models = training.train_regions(split, ["CAL", "NY"], S, options, searches=searches)
    rows = {(r["region"], r["split"], r["model"]): r["mae"] for r in errors.collect()}
    assert len(rows) == 8
    assert rows["CAL", "test", "model"] < rows["CAL", "test", "baseline"]

    ledger = Ledger(spark, folder)
    assert training.register_better(errors, models, ledger, "r", "1.0.0", options) == ["CAL", "NY"]
    assert ledger.runs().count() == 8
    training.log_searches(searches, ledger, "s")
    training.log_searches({}, ledger, "s")
    logged = ledger.runs().where("run_id = 's'").collect()
    assert sorted((r["region"], r["name"][:10], r["value"] == "ok") for r in logged) == [
        ("CAL", "search_mae", False), ("CAL", "search_sta", True),
        ("NY", "search_mae", False), ("NY", "search_sta", True),
    ]
    loaded = scoring.load_models(ledger, ["CAL", "NY", "SW"], "Production")
    assert sorted(loaded) == ["CAL", "NY"]
    assert scoring.load_models(ledger, ["CAL"], "Staging") == {}

    features = split.drop("split", "target")
    forecast = features.select("region", "timestamp_ms", (F.col("demand") + 1).alias("forecast"))
    table = scoring.prediction_table(features, forecast, loaded)
    assert table.groupBy("region").count().collect()[0]["count"] == 400
    open_rows = table.filter("demand IS NULL").collect()
    assert {(r["region"], r["timestamp_ms"]) for r in open_rows} == {
        ("CAL", START + 400 * HOUR), ("NY", START + 400 * HOUR)}
    wanted = dims.region_zones(spark).select("region")
    status = {r["region"]: r["status"] for r in scoring.region_status(features, loaded, wanted).collect()}
    assert status["CAL"] == "ok" and status["SW"] == "no model"
    described = training.describe(split).filter("region = 'NY' AND split = 'train'").first()
    assert (described["n_rows"], described["first_ms"]) == (320, START)


def _endless(spark):
    """A job of one task that does not end by itself."""
    return spark.range(0, 10**15, 1, 1).agg(F.sum(F.hash("id"))).collect()


def test_bounded_calls_overlap_and_do_not_stop_each_other(spark):
    both = threading.Barrier(2, timeout=60)
    gate = threading.Event()

    def fails():
        both.wait()
        raise ValueError("no good\nmore")

    calls = {
        "a": lambda: (both.wait(), spark.range(10).count())[1],
        "b": fails,
        "stuck": lambda: _endless(spark),
        "deaf": lambda: gate.wait(120),
        "c": lambda: spark.range(7).count(),
        "d": lambda: spark.range(8).count(),
    }
    began = time.monotonic()
    out = run_bounded(spark, calls, parallel=2, limit_s=8, grace_s=4)
    gate.set()
    assert list(out) == list(calls)
    assert [o.status for o in out.values()] == ["ok", "failed", "timed out", "timed out", "ok", "ok"]
    assert (out["a"].value, out["c"].value, out["d"].value) == (10, 7, 8)
    assert out["b"].message == "no good" and out["deaf"].message == "left behind"
    assert time.monotonic() - began < 60
    # No job of the cancelled call is left.
    tracker = spark.sparkContext.statusTracker()
    assert not tracker.getActiveJobsIds()


def test_search_leaves_out_a_candidate_that_is_stuck(spark, split, monkeypatch):
    one = split.filter("region = 'CAL' AND split = 'train'").drop("split")
    good, stuck, bad = (boosted.Params(maxIter=2, maxDepth=d) for d in (3, 4, 5))
    fit = boosted.fit

    def fitted(train, params):
        if params == stuck:
            _endless(spark)
        if params == bad:
            raise ValueError("bad candidate")
        return fit(train, params)

    monkeypatch.setattr(boosted, "fit", fitted)
    best, scores = boosted.search(one, [stuck, bad, good], S, 2, parallel=2, limit_s=25)
    assert best == good
    rows = {(r["params_id"], r["fold"]): (r["region"], r["status"]) for r in scores.collect()}
    assert rows == {
        (good.params_id, 0): ("CAL", "ok"),
        (good.params_id, 1): ("CAL", "ok"),
        (stuck.params_id, None): ("CAL", "timed out"),
        (bad.params_id, None): ("CAL", "failed"),
    }
    with pytest.raises(RuntimeError, match="bad candidate"):
        boosted.search(one, [bad], S, 2)
