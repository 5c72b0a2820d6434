"""Reshaping, row selection, weather means, evaluation tables and payload files."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from loadcast import dims
from loadcast.functions.time import DAY_MS
from loadcast.operators import evaluate, joins, profiles, quality, ranges, registry, reshape, weather
from loadcast.operators.series import Series
from loadcast.schemas import REGISTRY_RECORD, WEATHER_FIELDS
from loadcast.sources import payloads
from tests.helpers import HOUR, START

LONG = (
    "timestamp_ms long, human_read_period string, region string, electricity_demand long, "
    "electricity_demand_type string, seq long"
)
MERGED = "timestamp_ms long, human_read_period string, region string, demand long, forecast long"


def _long(spark, rows):
    return spark.createDataFrame([(START + h * HOUR, f"h{h}", r, v, t, s) for h, r, v, t, s in rows], LONG)


def test_merge_keeps_the_last_write_and_null_for_missing_types(spark):
    rows = [(0, "a", 1, "D", 1), (0, "a", 2, "D", 5), (0, "a", 3, "D", 4), (0, "a", 9, "TI", 1),
            (1, "a", 7, "DF", 1), (0, "b", 4, "XX", 1)]
    got = reshape.merge_metrics(_long(spark, rows), "seq").orderBy("timestamp_ms").collect()
    assert [tuple(r)[3:] for r in got] == [(2, None, 9, None), (None, 7, None, None)]


def test_merge_lets_a_later_null_win(spark):
    got = reshape.merge_metrics(_long(spark, [(0, "a", 1, "D", 1), (0, "a", None, "D", 2)]), "seq")
    assert got.first()["demand"] is None


def test_strict_pivot_and_strict_types_fail(spark):
    twice = _long(spark, [(0, "a", 1, "D", 1), (0, "a", 2, "D", 2)])
    with pytest.raises(Exception, match="duplicate D"):
        reshape.pivot_metrics(twice).collect()
    with pytest.raises(Exception, match="unknown metric type"):
        reshape.known_types(_long(spark, [(0, "a", 1, "XX", 1)]), strict=True).collect()
    with pytest.raises(Exception, match="unknown metric type"):
        reshape.known_types(_long(spark, [(0, "a", 1, None, 1)]), strict=True).collect()


def test_melt_of_a_pivot_is_the_identity(spark):
    rows = [(h, "a", h * 10 + k, t, 1) for h in range(5) for k, t in enumerate(("D", "DF", "TI", "NG"))]
    long = _long(spark, rows)
    wide = reshape.pivot_metrics(long)
    labels = {t: t for t in ("D", "DF", "TI", "NG", "absent")}
    back = reshape.melt_series(wide, ["timestamp_ms", "region"], labels, "t", "v")
    want = long.select("timestamp_ms", "region", "electricity_demand_type", F.col("electricity_demand").cast("double"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))


def test_names_there_and_back(spark):
    wide = spark.createDataFrame([(1, "a", 1, 2, 3, 4)], "timestamp_ms long, region string, D int, DF int, TI int, NG int")
    scoring = reshape.rename_metrics(wide)
    assert scoring.columns[2:] == ["demand", "demand_forecast", "total_interchange", "net_generation"]
    assert reshape.canonical_metrics(scoring).columns[2:] == ["demand", "forecast", "ti", "ng"]


def _trim(spark, pairs):
    rows = [(START + k * HOUR, str(k), "a", d, f) for k, (d, f) in enumerate(pairs)]
    rows += [(START + k * HOUR, str(k), "b", 1, None) for k in range(3)]
    got = quality.trim_after_last_actual(spark.createDataFrame(rows, MERGED), Series(chunk_ms=2 * HOUR))
    assert got.filter("region = 'b'").count() == 3
    return sorted(int(r["human_read_period"]) for r in got.filter("region = 'a'").collect())


@pytest.mark.parametrize(
    "pairs, kept",
    [
        ([(1, 1), (2, 1), (None, 1), (None, 1), (None, 1)], [0, 1, 2]),  # forecast at the end
        ([(1, 1), (None, 1), (2, None), (None, 1)], [0, 2]),  # none: only actual rows
        ([(1, 1), (None, 1), (2, 1)], [0, 1, 2]),  # nothing behind the last actual
        ([(None, 1)] * 4, []),
    ],
)
def test_trim_after_last_actual(spark, pairs, kept):
    assert _trim(spark, pairs) == kept


def test_keep_last_drops_only_inner_nulls(spark):
    rows = [(START + k * HOUR, str(k), "a", d, 1) for k, d in enumerate([1, None, 3, None])]
    df = spark.createDataFrame(rows, MERGED)
    got = quality.drop_incomplete_keep_last(df, "region", "timestamp_ms").collect()
    assert sorted(r["human_read_period"] for r in got) == ["0", "2", "3"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "x double")
    assert quality.drop_incomplete(df).count() == 1


@pytest.mark.parametrize(
    "first_hour, n, page, kept, next_start",
    [
        (0, 30, 30, 24, 24),  # full page ending mid-day
        (0, 24, 24, 24, 24),  # full page ending on hour 23
        (0, 20, 30, 20, None),  # short page
        (0, 10, 10, 10, 10),  # full page without an hour 23: next hour
    ],
)
def test_complete_day_trim(spark, first_hour, n, page, kept, next_start):
    rows = [("a", START + (first_hour + h) * HOUR) for h in range(n)]
    df = spark.createDataFrame(rows, "region string, timestamp_ms long")
    got = quality.complete_day_trim(df, "region", "timestamp_ms", page).collect()
    assert len(got) == kept
    starts = {r["next_start_ms"] for r in got}
    assert starts == {None if next_start is None else START + next_start * HOUR}


def test_page_fullness_can_come_from_raw_rows(spark):
    df = spark.createDataFrame([("a", START, 4), ("a", START + HOUR, 3)], "region string, timestamp_ms long, n int")
    cut = quality.page_cut(df, "region", "timestamp_ms", 7, F.sum("n")).first()
    assert cut["next_start_ms"] == START + 2 * HOUR


def test_dedupe_latest_keeps_nulls_of_the_latest_row(spark):
    df = spark.createDataFrame([("a", 1, 5, 1), ("a", 1, None, 2), ("b", 1, 7, 1)], "k string, t int, v int, seq int")
    got = quality.dedupe_latest(df, ["k", "t"], "seq")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1, None, 2), ("b", 1, 7, 1)]


def test_whitelist(spark):
    asked = spark.createDataFrame([("CAL",), ("XYZ",), ("XYZ",)], "region string")
    assert [r[0] for r in quality.invalid_keys(asked, dims.valid_regions(spark), "region").collect()] == ["XYZ"]
    assert quality.require_valid(["NY"], dims.VALID_REGIONS) == ["NY"]
    with pytest.raises(ValueError, match="XYZ"):
        quality.require_valid(["NY", "XYZ"], dims.VALID_REGIONS)


def test_dimension_sizes(spark):
    assert dims.valid_regions(spark).count() == 13
    assert dims.region_cities(spark).count() == 42
    assert dims.region_zones(spark).count() == 8
    assert dims.state_regions(spark).count() == 29


def test_ranges():
    as_of = START + 20 * DAY_MS + 15 * HOUR + 1234
    shifted = ranges.shifted_range(as_of, 5)
    assert (shifted.start_ms, shifted.end_ms) == (START + 7 * DAY_MS + 15 * HOUR, START + 12 * DAY_MS + 15 * HOUR)
    aligned = ranges.day_aligned_range(as_of, 48)
    assert (aligned.start_ms, aligned.end_ms) == (START + 18 * DAY_MS, START + 21 * DAY_MS)


def test_city_means(spark):
    rows = [("a", START, "p", 1.0, 2.0), ("a", START, "p", 3.0, math.nan), ("a", START, "p", 5.0, None)]
    df = spark.createDataFrame(rows, "region string, timestamp_ms long, human_read_period string, t double, s double")
    loose = weather.region_mean(df, True, ("t", "s")).first()
    strict = weather.region_mean(df, False, ("t", "s")).first()
    assert (loose["t"], loose["s"]) == (3.0, 2.0)
    assert (strict["t"], strict["s"]) == (3.0, None)


def test_standardize_and_constant_columns(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 5.0)], "region string, x double, c double")
    got = sorted((r["x"], r["c"]) for r in evaluate.standardize(df, "region", ["x", "c"]).collect())
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("accuracy", [20, 50, 100_000])
def test_exact_quantiles_whatever_the_accuracy(spark, accuracy):
    draw = random.Random(4)
    rows = [("a", draw.gauss(0, 1)) for _ in range(4000)] + [("b", float(k // 300)) for k in range(2000)]
    rows += [("c", 1.5), ("d", -2.0), ("d", 7.0), (None, 3.0), ("a", None), ("e", None)]
    rows += [("f", float(draw.randrange(3))) for _ in range(700)]
    df = spark.createDataFrame(rows, "g string, x double")
    fractions = [0.0, 1 / 16, 0.25, 0.5, 0.7, 15 / 16, 1.0]
    got = evaluate.exact_quantiles(df.where("x IS NOT NULL"), ["g"], "x", fractions, accuracy)
    found = {r["g"]: r["cuts"] for r in got.where("g IS NOT NULL").collect()}
    for g in "abcdf":
        values = sorted(x for k, x in rows if k == g and x is not None)
        want = [values[max(1, math.ceil(p * len(values))) - 1] for p in fractions]
        assert found[g] == want, g
    assert set(found) == set("abcdf")


def test_mutual_information_does_not_depend_on_the_accuracy(spark):
    draw = random.Random(9)
    rows = [("a", float(k % 97), draw.random(), float(k % 97) + draw.random()) for k in range(1500)]
    df = spark.createDataFrame(rows, "region string, x double, z double, y double")
    found = [
        {r["feature"]: round(r["importance"], 9) for r in evaluate.mutual_information(
            df, "region", ["x", "z"], "y", accuracy=a).collect()}
        for a in (30, 100_000)
    ]
    assert found[0] == found[1] and found[0]["x"] > found[0]["z"]


def test_mutual_information_ranks_the_related_feature_first(spark):
    df = spark.range(0, 4000).select(
        F.lit("a").alias("region"),
        F.rand(1).alias("noise"),
        F.rand(2).alias("y"),
        F.lit(1.0).alias("constant"),
    ).withColumn("same", F.col("y") * 3 + 1)
    got = {r["feature"]: r["importance"] for r in evaluate.mutual_information(
        df, "region", ["noise", "same", "constant"], "y", bins=8).collect()}
    assert got["same"] == pytest.approx(math.log(8), abs=0.01)
    assert got["constant"] == pytest.approx(0) and got["noise"] < 0.05


def test_gate_baseline_and_best_parameters(spark):
    mae = spark.createDataFrame(
        [("a", "model", 1.0), ("a", "baseline", 2.0), ("b", "model", 2.0), ("b", "baseline", 2.0)],
        "region string, model string, mae double")
    assert [r["region"] for r in evaluate.registration_gate(mae).collect()] == ["a"]
    with pytest.raises(ValueError, match="missing"):
        evaluate.persistence(mae)
    folds = spark.createDataFrame(
        [("a", "p", 1.0), ("a", "p", 3.0), ("a", "q", 1.5), ("a", "q", 1.7)],
        "region string, params_id string, mae double")
    best = evaluate.best_parameters(evaluate.cross_validation_score(folds)).first()
    assert (best["params_id"], best["mean_mae"]) == ("q", pytest.approx(1.6))


def test_registry_choice(spark):
    def model(name, region, tuned, *versions):
        return name, region, tuned, [(v, s, f"run-{v}") for v, s in versions]

    rows = [
        model("a_plain", "a", False, *[(f"9.{k}.0", "Production") for k in range(5)]),
        model("a_tuned", "a", True, ("1.2.0", "Production"), ("1.10.0", "Production"), ("2.0.0", "Staging")),
        model("b_plain", "b", False, ("1.9.3", "Production"), ("1.10.0", "Production")),
        model("b_other", "b", False, ("8.0.0", "Production")),
        model("c_plain", "c", False, ("1.0.0", "Staging")),
        model("d_two", "d", True, ("1.0.0", "Production")),
        model("d_one", "d", True, ("1.0.0", "Production")),
    ]
    versions = registry.versions_long(spark.createDataFrame(rows, REGISTRY_RECORD))
    got = registry.pick_models(versions, "Production").collect()
    assert sorted((r["region"], r["name"], r["version"]) for r in got) == [
        ("a", "a_tuned", "1.10.0"), ("b", "b_plain", "1.10.0"), ("d", "d_one", "1.0.0"),
    ]


def test_debug_predictions_append_the_open_hour(spark):
    actual = spark.createDataFrame([("a", START + h * HOUR, h, h) for h in range(4)],
                                   "region string, timestamp_ms long, demand long, forecast long")
    scored = spark.createDataFrame([("a", START + h * HOUR, float(h)) for h in range(4)],
                                   "region string, timestamp_ms long, prediction double")
    got = sorted(joins.debug_predictions(actual, scored).collect(), key=lambda r: r["timestamp_ms"])
    assert [(r["demand"], r["prediction"]) for r in got] == [(1, 0.0), (2, 1.0), (3, 2.0), (None, 3.0)]


def test_local_profile_needs_a_zone(spark):
    df = spark.createDataFrame([("NE", START, 1)], "region string, timestamp_ms long, demand long")
    with pytest.raises(Exception, match="no time zone for region NE"):
        profiles.with_local_time(df, dims.region_zones(spark)).collect()
    cal = df.withColumn("region", F.lit("CAL"))
    row = profiles.with_local_time(cal, dims.region_zones(spark)).first()
    assert (row["hour"], row["day_of_week"], row["is_weekend"], row["part_of_day"]) == (16, 6, 1, "Afternoon")


def _dump(path, *documents):
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def test_demand_payload_files(spark, tmp_path):
    def record(period, kind, value):
        return {"period": period, "respondent": "CAL", "type": kind, "value": value}

    page = {"response": {"data": [record("2024-01-01T00", "D", "12"), record("2024-01-01T00", "DF", None),
                                  record("2024-01-01T01", "D", "x")]}}
    path = _dump(tmp_path / "demand.json", page, {"response": {"data": []}})
    typed = reshape.typed_records(payloads.read_demand_payloads(spark, path)).collect()
    assert [r["electricity_demand"] for r in typed] == [12, None, None]
    assert typed[2]["timestamp_ms"] == START + HOUR


def test_weather_payload_files(spark, tmp_path):
    def city(name, status=200, radiation=True, temperature=(1.0, 2.0)):
        hourly = {"time": ["2024-01-01T00:00", "2024-01-01T01:00"]}
        for field in WEATHER_FIELDS:
            if radiation or field not in payloads.OPTIONAL_WEATHER_FIELDS:
                hourly[field] = list(temperature)
        return {"status": status, "region": "CAL", "city": name, "hourly": hourly}

    path = _dump(tmp_path / "weather.json", city("x"), city("y", radiation=False, temperature=(3.0, None)),
                 city("z", status=500))
    rows = payloads.read_weather_payloads(spark, path)
    assert rows.count() == 4 and rows.filter("city = 'y' AND solar_radiation IS NULL").count() == 2
    means = {r["timestamp_ms"]: r for r in weather.region_mean(rows).collect()}
    assert means[START]["temperature"] == 2.0 and means[START]["solar_radiation"] == 1.0
    strict = {r["timestamp_ms"]: r for r in weather.regional_history(rows, F.lit(START)).collect()}
    assert list(strict) == [START] and strict[START]["solar_radiation"] is None


def test_state_shapes(spark, tmp_path):
    def feature(name):
        return {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[1, 2]]]},
                "properties": {"NAME": name}}

    path = _dump(tmp_path / "states.json", {"features": [feature("Ohio"), feature("Guam"), feature("Utah")]})
    got = payloads.read_state_shapes(spark, path, dims.state_regions(spark)).collect()
    assert sorted((r["NAME"], r["region"], r["properties"]["region"]) for r in got) == [
        ("Ohio", "MIDW", "MIDW"), ("Utah", "SW", "SW")]
    assert json.loads(got[0]["geometry"]["coordinates"]) == [[[1, 2]]]
