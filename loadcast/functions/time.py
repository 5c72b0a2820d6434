"""Time expressions.

Fields of an epoch-millisecond column are integer arithmetic, so they do not depend on the
session time zone and stay in generated code on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS

PERIOD = "yyyy-MM-dd'T'HH"
MINUTE_PERIOD = "yyyy-MM-dd'T'HH:mm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_ms(ms: Column | str, width_ms: int) -> Column:
    ms = _col(ms)
    return ms - F.pmod(ms, F.lit(width_ms))


def bucket_of(ms: Column | str, width_ms: int) -> Column:
    """Number of the ``width_ms`` wide bucket that holds ``ms`` (exact for negatives)."""
    # An exact multiple, so the double quotient is exact up to 2**53.
    return (floor_ms(ms, width_ms) / F.lit(width_ms)).cast("long")


def event_time(ms: Column | str) -> Column:
    return F.timestamp_millis(_col(ms))


def parse_period(text: Column | str, fmt: str = PERIOD, strict: bool = False) -> Column:
    """Period text, read as UTC, to epoch milliseconds; bad text is NULL or an error."""
    text = _col(text)
    parsed = F.to_timestamp(text, fmt) if strict else F.try_to_timestamp(text, F.lit(fmt))
    return F.unix_millis(parsed)


def parse_minute_period(text: Column | str, strict: bool = False) -> Column:
    return parse_period(text, MINUTE_PERIOD, strict)


def format_period(ms: Column | str, fmt: str = PERIOD) -> Column:
    return F.date_format(event_time(ms), fmt)


def utc_date(ms: Column | str) -> Column:
    return F.date_from_unix_date(bucket_of(ms, DAY_MS).cast("int"))


def utc_hour(ms: Column | str) -> Column:
    return F.pmod(bucket_of(ms, HOUR_MS), F.lit(24)).cast("int")


def utc_weekday(ms: Column | str) -> Column:
    """Monday is 0.  Day 0 of the epoch was a Thursday."""
    return F.pmod(bucket_of(ms, DAY_MS) + 3, F.lit(7)).cast("int")


def utc_month(ms: Column | str) -> Column:
    return F.month(utc_date(ms))


def is_weekend(weekday: Column) -> Column:
    return (weekday >= 5).cast("int")


def part_of_day(hour: Column) -> Column:
    return (
        F.when(hour < 6, "Night")
        .when(hour < 12, "Morning")
        .when(hour < 18, "Afternoon")
        .otherwise("Evening")
    )


def local_time(ms: Column | str, zone: Column | str) -> Column:
    """Wall clock of ``zone`` without an offset; daylight saving follows the zone rules."""
    return F.from_utc_timestamp(event_time(ms), _col(zone)).cast("timestamp_ntz")


# --- calendar features -----------------------------------------------------------------

# US public holidays as a rule over month, day and weekday (Monday is 0), so no holiday table
# has to be built, bounded or joined.  First years and dates are fixed values.
#
# Dates that move to Friday or Monday when they fall on a weekend, as month * 100 + day.
_MOVABLE = """(
  ({md} IN (101, 704, 1225) AND {year} >= 1871)
  OR ({md} = 1111 AND {year} >= 1938 AND {year} NOT BETWEEN 1971 AND 1977)
  OR ({md} = 619 AND {year} >= 2021))"""

_HOLIDAY = f"""cast(
  {_MOVABLE.format(md="_md", year="_year")}
  OR (_weekday = 4 AND {_MOVABLE.format(md="_md_after", year="_year_after")})
  OR (_weekday = 0 AND {_MOVABLE.format(md="_md_before", year="_year")})
  OR (_weekday = 0 AND (
       (_md BETWEEN 115 AND 121 AND _year >= 1986)
    OR (_md BETWEEN 215 AND 221 AND _year >= 1971)
    OR (_md BETWEEN 525 AND 531 AND _year >= 1971)
    OR (_md BETWEEN 901 AND 907 AND _year >= 1894)
    OR (_md BETWEEN 1008 AND 1014 AND _year >= 1970)
    OR (_md BETWEEN 1022 AND 1028 AND _year BETWEEN 1971 AND 1977)))
  OR (_weekday = 3 AND _md BETWEEN 1122 AND 1128 AND _year >= 1871)
  OR (_md = 222 AND _year BETWEEN 1879 AND 1970)
  OR (_md = 530 AND _year BETWEEN 1888 AND 1970)
  OR (_md = 1012 AND _year BETWEEN 1937 AND 1969) AS int)"""

# Three short projections.  Each one uses columns of the one before more than once, so the
# optimizer keeps them apart and no date is taken to pieces twice.
_DATE_PARTS = {
    "_year": "year(_date)",
    "_month": "month(_date)",
    "_md": "month(_date) * 100 + day(_date)",
    "_weekday": "weekday(_date)",
    "_year_after": "year(date_add(_date, 1))",
    "_md_after": "month(date_add(_date, 1)) * 100 + day(date_add(_date, 1))",
    "_md_before": "month(date_add(_date, -1)) * 100 + day(date_add(_date, -1))",
}

_CATEGORY = """CASE WHEN _hour BETWEEN 18 AND 22 THEN 'evening_peak'
  WHEN _hour BETWEEN 9 AND 17 AND _weekday < 5 THEN 'office_hours' ELSE 'off_peak' END"""
_NUMBER = """CASE hour_category WHEN 'office_hours' THEN 1 WHEN 'evening_peak' THEN 2
  ELSE 0 END"""
_CALENDAR = {
    "hour_category": _CATEGORY,
    "hour_category_num": _NUMBER,
    "is_holiday": _HOLIDAY,
    "hour_sin": "sin(2 * pi() * _hour / 24)",
    "hour_cos": "cos(2 * pi() * _hour / 24)",
    "day_of_week_sin": "sin(2 * pi() * _weekday / 7)",
    "day_of_week_cos": "cos(2 * pi() * _weekday / 7)",
    "month_sin": "sin(2 * pi() * _month / 12)",
    "month_cos": "cos(2 * pi() * _month / 12)",
}


def _with_date_parts(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in _DATE_PARTS.items()])


def with_holiday(df: DataFrame, date: Column | str, name: str = "is_holiday") -> DataFrame:
    """Add the 0/1 flag of US public holidays, observed days included."""
    parts = _with_date_parts(df.withColumn("_date", _col(date)))
    return parts.selectExpr("*", f"{_HOLIDAY} AS {name}").drop("_date", *_DATE_PARTS)


def with_calendar(df: DataFrame, ms: str = "timestamp_ms") -> DataFrame:
    """Add the nine calendar features of an event time; works on batch and streaming frames."""
    parts = _with_date_parts(df.withColumns({"_date": utc_date(ms), "_hour": utc_hour(ms)}))
    out = parts.selectExpr("*", *[f"{sql} AS {name}" for name, sql in _CALENDAR.items()])
    return out.drop("_date", "_hour", *_DATE_PARTS)


def local_columns(ms: Column | str, zone: Column | str) -> dict[str, Column]:
    """Fields of the regional wall clock, as used by the profiles."""
    local = local_time(ms, zone)
    hour, weekday = F.hour(local), F.weekday(local)
    return {
        "timestamp": local,
        "hour": hour,
        "day_of_week": weekday,
        "month": F.month(local),
        "is_weekend": is_weekend(weekday),
        "part_of_day": part_of_day(hour),
    }
