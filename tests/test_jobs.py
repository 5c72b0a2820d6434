"""The whole chain over folders: payloads, topics, tables, models, scores."""

import json
import os
import runpy
import subprocess
import sys
from pathlib import Path

import pytest

from loadcast.schemas import WEATHER_FIELDS
from tests.helpers import HOUR, START

JOBS = Path(__file__).resolve().parents[1] / "jobs"
HOURS = 24 * 12
# The jobs look back from 192 hours before this moment.
AS_OF = START + (HOURS + 192) * HOUR
REGIONS = ("CAL", "NY")


def _run(monkeypatch, job, *args):
    monkeypatch.setattr(sys, "argv", [job, "--run-id", "r1", "--regions", ",".join(REGIONS), *args])
    runpy.run_path(str(JOBS / f"{job}.py"), run_name="__main__")


def _period(hour, fmt="%Y-%m-%dT%H"):
    import datetime

    t = datetime.datetime.fromtimestamp(START / 1000 + 3600 * hour, datetime.timezone.utc)
    return t.strftime(fmt)


@pytest.fixture
def landed(tmp_path):
    demand, weather = tmp_path / "demand", tmp_path / "weather"
    demand.mkdir(), weather.mkdir()
    for region in REGIONS:
        data = [
            {"period": _period(h), "respondent": region, "type": t, "value": str(1000 + 10 * (h % 24) + k)}
            for h in range(HOURS)
            for k, t in enumerate(("D", "DF", "TI", "NG"))
        ]
        (demand / f"{region}.json").write_text(json.dumps({"response": {"data": data}}))
        hourly = {"time": [_period(h, "%Y-%m-%dT%H:%M") for h in range(HOURS)]}
        hourly.update({f: [float(h % 24) for h in range(HOURS)] for f in WEATHER_FIELDS})
        cities = [{"status": 200, "region": region, "city": c, "hourly": hourly} for c in "xy"]
        (weather / f"{region}.json").write_text("\n".join(json.dumps(c) for c in cities))
    return tmp_path


def test_chain(spark, landed, monkeypatch):
    at = lambda name: str(landed / name)
    as_of = ("--as-of-ms", str(AS_OF))
    _run(monkeypatch, "ingest_demand", "--payloads", at("demand"), "--topic", at("t_demand"), *as_of)
    _run(monkeypatch, "build_features", "--source", at("t_demand"), "--target", at("t_feat"),
         "--checkpoint", at("ckpt"), "--state-partitions", "2")
    _run(monkeypatch, "ingest_weather", "--payloads", at("weather"), "--topic", at("t_weather"), *as_of)
    for record, topic in (("demand", "t_feat"), ("weather", "t_weather")):
        _run(monkeypatch, "store_features", "--record", record, "--store", at("store"),
             "--table", record, "--source", at(topic), "--checkpoint", at("ckpt"))

    from loadcast.store.tables import FeatureStore

    stored = FeatureStore(spark, at("store"))
    assert stored.table("demand_r1", 1).read().count() == 2 * HOURS
    assert stored.table("weather_r1", 1).read().count() > 0

    _run(monkeypatch, "train", "--store", at("store"), "--status", "Production", "--max-iter", "2",
         "--debug-path", at("debug"), *as_of)
    assert spark.read.option("header", True).csv(at("debug/predictions")).count() > 0
    logged = {r["name"] for r in spark.read.parquet(at("store/runs")).collect()}
    assert {"rows_train", "first_ms_test", "last_ms_test", "mae_model_test"} <= logged
    _run(monkeypatch, "score", "--store", at("store"), "--payloads", at("demand"), "--output", at("out"),
         "--as-of-ms", str(START + HOURS * HOUR))
    status = {r["region"]: r["status"] for r in spark.read.parquet(at("out/status")).collect()}
    assert status == dict.fromkeys(REGIONS, "ok")
    predictions = spark.read.parquet(at("out/predictions"))
    open_rows = predictions.filter("demand IS NULL")
    assert {r["region"] for r in open_rows.collect()} == set(REGIONS)
    assert spark.read.parquet(at("out/accuracy")).count() == 5 * len(REGIONS)
    assert spark.read.parquet(at("out/hourly")).count() == 24 * len(REGIONS)
    assert spark.read.parquet(at("out/importance")).filter("feature = 'lag_1h'").count() == 2


@pytest.mark.parametrize("job", sorted(p.stem for p in JOBS.glob("*.py") if p.stem not in ("__init__", "check_queries")))
def test_every_job_starts_from_another_folder(job, tmp_path):
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, str(JOBS / f"{job}.py"), "--help"]
    done = subprocess.run(command, cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=60)
    assert done.returncode == 0 and "--run-id" in done.stdout, done.stderr


def test_pages_landed_with_overlap_lose_no_hour(spark, tmp_path, monkeypatch):
    (tmp_path / "pages").mkdir()
    hours = [range(0, 30), range(24, 54), range(48, 60)]
    for page, span in enumerate(hours):
        data = [{"period": _period(h), "respondent": "CAL", "type": "D", "value": str(100 * page + h)} for h in span]
        (tmp_path / "pages" / f"page_{8 + page}.json").write_text(json.dumps({"response": {"data": data}}))
        os.utime(tmp_path / "pages" / f"page_{8 + page}.json", (1_700_000_000 + page,) * 2)
    _run(monkeypatch, "ingest_demand", "--payloads", str(tmp_path / "pages"), "--topic", str(tmp_path / "t"),
         "--page-rows", "20", "--as-of-ms", str(START + (100 + 192) * HOUR))
    sent = [json.loads(r["value"]) for r in spark.read.json(str(tmp_path / "t_r1")).collect()]
    got = {r["human_read_period"]: r["demand"] for r in sent}
    assert got == {_period(h): 100 * min(2, h // 24) + h for h in range(60)}


def test_unusable_rows_are_kept_apart(spark, tmp_path, monkeypatch):
    (tmp_path / "pages").mkdir()
    data = [{"period": _period(h), "respondent": "CAL", "type": "D", "value": str(h)} for h in range(30)]
    wrong = {3: {"type": "??"}, 5: {"period": "yesterday"}, 7: {"respondent": "XX"}, 9: {"value": "many"}}
    for at, change in wrong.items():
        data[at].update(change)
    (tmp_path / "pages" / "page.json").write_text(json.dumps({"response": {"data": data}}))
    common = ("--payloads", str(tmp_path / "pages"), "--as-of-ms", str(START + (100 + 192) * HOUR))
    with pytest.raises(Exception, match="unknown metric type"):
        _run(monkeypatch, "ingest_demand", "--topic", str(tmp_path / "strict"), *common)
    for topic in ("first", "again"):  # the second run finds its rejects stored
        _run(monkeypatch, "ingest_demand", "--topic", str(tmp_path / topic), *common,
             "--rejects", str(tmp_path / "kept"))
        sent = [json.loads(r["value"]) for r in spark.read.json(str(tmp_path / f"{topic}_r1")).collect()]
        assert sorted(r["demand"] for r in sent) == [h for h in range(30) if h not in wrong]

    from loadcast.store.rejects import RejectTable

    schema = "period string, respondent string, type string, value string, seq string"
    rows = RejectTable(spark, str(tmp_path / "kept")).read(spark.createDataFrame([], schema).schema)
    assert sorted((r["batch"], r["reason"], r["value"]) for r in rows.collect()) == [
        ("r1", "bad number", "many"), ("r1", "bad period", "5"),
        ("r1", "unknown region", "7"), ("r1", "unknown type", "3"),
    ]
    assert rows.where("seq IS NULL").isEmpty()
