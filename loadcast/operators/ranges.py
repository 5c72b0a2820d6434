"""Look-back ranges and time predicates, always relative to an explicit ``as_of``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.functions.time import DAY_MS, HOUR_MS

DEFAULT_SHIFT_HOURS = 192


@dataclass(frozen=True)
class TimeRange:
    """Half-open or closed range of epoch milliseconds; plain numbers push down to the scan."""

    start_ms: int
    end_ms: int

    def contains(self, ms: str, closed: bool = True) -> Column:
        upper = F.col(ms) <= self.end_ms if closed else F.col(ms) < self.end_ms
        return (F.col(ms) >= self.start_ms) & upper


def _floor(ms: int, width: int) -> int:
    return ms - ms % width


def shifted_range(
    as_of_ms: int, last_n_days: int, shift_hours: int = DEFAULT_SHIFT_HOURS
) -> TimeRange:
    """``last_n_days`` up to ``shift_hours`` before ``as_of``, on full hours."""
    end = as_of_ms - shift_hours * HOUR_MS
    return TimeRange(_floor(end - last_n_days * DAY_MS, HOUR_MS), _floor(end, HOUR_MS))


def day_aligned_range(as_of_ms: int, hours_back: int, hours_ahead: int = 24) -> TimeRange:
    """From midnight of the day ``hours_back`` ago to midnight of the day ``hours_ahead`` on."""
    return TimeRange(
        _floor(as_of_ms - hours_back * HOUR_MS, DAY_MS),
        _floor(as_of_ms + hours_ahead * HOUR_MS, DAY_MS),
    )


def facet_page(
    raw: DataFrame,
    region: str,
    start: str,
    end: str,
    offset: int = 0,
    length: int = 5000,
    order: tuple[str, ...] = ("period",),
) -> DataFrame:
    """One page of a region's raw rows in time order.

    The page is the unit of the source protocol.  Sort and limit become one top-k operator:
    each task keeps ``offset + length`` rows, so no full sort takes place.
    """
    page = raw.filter((F.col("respondent") == region) & F.col("period").between(start, end))
    return page.orderBy(*order).offset(offset).limit(length)
