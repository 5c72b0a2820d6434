"""Calendar, zones, numbers and text."""

import datetime

import pytest
from pyspark.sql import functions as F

from loadcast.functions import numbers, text, time
from tests.helpers import HOUR, START


def _ms(*parts):
    return int(datetime.datetime(*parts, tzinfo=datetime.timezone.utc).timestamp() * 1000)


def _flags(spark, first, last):
    days = spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}')) AS d")
    rows = time.with_holiday(days, "d").filter("is_holiday = 1").orderBy("d").collect()
    return [r["d"].isoformat() for r in rows]


def test_holidays_of_a_year_with_observed_days(spark):
    assert _flags(spark, "2021-01-01", "2022-01-01") == [
        "2021-01-01", "2021-01-18", "2021-02-15", "2021-05-31", "2021-06-18", "2021-06-19",
        "2021-07-04", "2021-07-05", "2021-09-06", "2021-10-11", "2021-11-11", "2021-11-25",
        "2021-12-24", "2021-12-25", "2021-12-31", "2022-01-01",
    ]


@pytest.mark.parametrize(
    "first, last, days",
    [
        ("2020-06-01", "2020-07-31", ["2020-07-03", "2020-07-04"]),  # Saturday; June 19 later
        ("2024-07-01", "2024-07-31", ["2024-07-04"]),
        ("1985-01-02", "1985-01-31", []),  # third Monday of January from 1986
        ("1970-02-01", "1970-05-31", ["1970-02-22", "1970-05-30"]),  # fixed dates until 1970
        ("1975-10-01", "1975-11-30", ["1975-10-13", "1975-10-27", "1975-11-27"]),
        ("2023-11-01", "2023-11-30", ["2023-11-10", "2023-11-11", "2023-11-23"]),
    ],
)
def test_holiday_rules(spark, first, last, days):
    assert _flags(spark, first, last) == days


@pytest.mark.parametrize(
    "hour, friday, saturday",
    [
        (0, "off_peak", "off_peak"), (8, "off_peak", "off_peak"),
        (9, "office_hours", "off_peak"), (17, "office_hours", "off_peak"),
        (18, "evening_peak", "evening_peak"), (22, "evening_peak", "evening_peak"),
        (23, "off_peak", "off_peak"),
    ],
)
def test_hour_category(spark, hour, friday, saturday):
    rows = [(_ms(2024, 3, 1, hour),), (_ms(2024, 3, 2, hour),)]
    df = spark.createDataFrame(rows, "timestamp_ms long")
    got = time.with_calendar(df).orderBy("timestamp_ms").collect()
    assert [r["hour_category"] for r in got] == [friday, saturday]
    numbers_of = {"off_peak": 0, "office_hours": 1, "evening_peak": 2}
    assert [r["hour_category_num"] for r in got] == [numbers_of[friday], numbers_of[saturday]]


def test_cycles_lie_on_the_unit_circle(spark):
    df = spark.range(0, 24 * 400).select((F.col("id") * HOUR + START).alias("timestamp_ms"))
    df = time.with_calendar(df)
    for name in ("hour", "day_of_week", "month"):
        sin, cos = F.col(f"{name}_sin"), F.col(f"{name}_cos")
        off = F.abs(sin * sin + cos * cos - 1)
        assert df.select(F.max(off)).first()[0] < 1e-12


def test_time_fields_ignore_the_session_zone_and_work_before_1970(spark):
    moments = [_ms(1969, 12, 31, 23), _ms(1970, 1, 1, 0), _ms(2024, 2, 29, 5), _ms(1960, 3, 6, 1)]
    df = spark.createDataFrame([(m,) for m in moments], "ms long")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = df.select(
            "ms", time.utc_hour("ms"), time.utc_weekday("ms"), time.utc_month("ms"), time.utc_date("ms")
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for ms, hour, weekday, month, date in got:
        t = datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=ms)
        assert (hour, weekday, month, date) == (t.hour, t.weekday(), t.month, t.date())


@pytest.mark.parametrize(
    "zone, moment, local",
    [
        ("America/New_York", (2024, 3, 10, 6, 30), "2024-03-10 01:30"),
        ("America/New_York", (2024, 3, 10, 7, 30), "2024-03-10 03:30"),  # spring forward
        ("America/Los_Angeles", (2024, 11, 3, 9, 30), "2024-11-03 01:30"),  # fall back
        ("America/Phoenix", (2024, 7, 1, 12, 0), "2024-07-01 05:00"),  # no summer time
    ],
)
def test_local_time(spark, zone, moment, local):
    df = spark.createDataFrame([(_ms(*moment), zone)], "ms long, tz string")
    got = df.select(F.date_format(time.local_time("ms", "tz"), "yyyy-MM-dd HH:mm")).first()[0]
    assert got == local


def test_part_of_day(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r[0] for r in df.select(time.part_of_day(F.col("h"))).collect()]
    assert got == ["Night"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2


def test_periods(spark):
    df = spark.createDataFrame([("2024-01-01T05",), ("bad",), (None,)], "p string")
    got = [r[0] for r in df.select(time.parse_period("p")).collect()]
    assert got == [START + 5 * HOUR, None, None]
    with pytest.raises(Exception, match="bad"):
        df.select(time.parse_period("p", strict=True)).collect()
    one = spark.range(1)
    assert one.select(time.parse_minute_period(F.lit("2024-01-01T05:00"))).first()[0] == START + 5 * HOUR
    assert one.select(time.format_period(F.lit(START + 23 * HOUR))).first()[0] == "2024-01-01T23"


def _measure(spark, pairs, measure):
    df = spark.createDataFrame(pairs, "t double, p double")
    return df.select(measure(F.col("t"), F.col("p"))).first()[0]


def test_error_measures(spark):
    pairs = [(100.0, 110.0), (0.0, 5.0), (0.0, 0.0), (50.0, 25.0)]
    assert _measure(spark, pairs, numbers.mean_absolute_error) == pytest.approx(10)
    assert _measure(spark, pairs, numbers.mean_squared_error) == pytest.approx((100 + 25 + 625) / 4)
    # An infinite term counts as zero, zero over zero does not count.
    assert _measure(spark, pairs, numbers.mape) == pytest.approx((0.1 + 0 + 0.5) / 3 * 100)
    total = sum((t - 37.5) ** 2 for t, _ in pairs)
    assert _measure(spark, pairs, numbers.r_squared) == pytest.approx(1 - 750 / total)


@pytest.mark.parametrize("pairs, r2", [([(5.0, 5.0)] * 3, 1.0), ([(5.0, 4.0)] * 3, 0.0)])
def test_r2_of_constant_actuals(spark, pairs, r2):
    assert _measure(spark, pairs, numbers.r_squared) == r2


def test_version_order(spark):
    versions = ["1.2.0", "1.10.0", "1.9.3", "1.10.0rc1", "2.0.0-rc2", "2.0.0-rc10", "1.10", "0.9"]
    versions += ["20241201120000", "20241130235959.1"]
    df = spark.createDataFrame([(v,) for v in versions], "v string")
    key = text.version_key(F.col("v"))
    got = [r[0] for r in df.orderBy(key.desc(), "v").collect()]
    assert got == [
        "20241201120000", "20241130235959.1",
        "2.0.0-rc10", "2.0.0-rc2", "1.10", "1.10.0", "1.10.0rc1", "1.9.3", "1.2.0", "0.9",
    ]


def test_key_list(spark):
    assert spark.range(1).select(text.split_list(F.lit("region , timestamp_ms"))).first()[0] == [
        "region", "timestamp_ms",
    ]
