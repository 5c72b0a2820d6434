"""The registered queries: names, checks, and a run over the smallest data set."""

import pytest

import __spark_entry__ as entry
from jobs.check_queries import compare, connect
from loadcast.catalog import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Streams and models have their own tests; running them again here only takes time.
OWN_TESTS = {
    "model_training",
    "model_scoring",
    "model_search",
    "stream_features",
    "stream_features_late",
    "stream_readings",
    "stream_tap",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_checks_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OWN_TESTS))
def test_query_equals_its_check(spark, duck, name):
    # The smallest data may have no region that passes a filter.
    assert compare(spark, duck, SF_DIR, name) in ("", "equal but empty")


def test_flagship(spark):
    df = entry.entry(spark)
    assert {"region", "timestamp_ms", "mean_168", "target", "weather_temperature"} <= set(df.columns)
    assert df.count() > 0
