"""Numeric, NULL and error-measure expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_nan(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def whole_number(text: Column) -> Column:
    """Integer text to long; anything else is NULL (a plain cast raises in ANSI mode)."""
    return text.try_cast("bigint")


def truncated(c: Column) -> Column:
    """Towards zero, like an integer conversion of a float target."""
    return c.cast("bigint")


def mean_absolute_error(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def mean_squared_error(actual: Column, predicted: Column) -> Column:
    return F.avg((actual - predicted) * (actual - predicted))


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error.

    A zero actual with an error is an infinite term and counts as 0; zero over zero is no
    term at all.
    """
    term = F.when(actual != 0, F.abs((actual - predicted) / actual)).when(
        predicted != 0, F.lit(0.0)
    )
    return F.avg(term) * 100


def r_squared(actual: Column, predicted: Column) -> Column:
    """1 - residual / total sum of squares, not the squared correlation.

    The total comes from ``var_pop``, which merges partial aggregates without the
    cancellation of sum(x*x) - n*mean**2.  Constant actuals give 1 (exact fit) or 0.
    """
    residual = F.sum((actual - predicted) * (actual - predicted))
    total = F.var_pop(actual) * F.count(actual)
    return F.when(total > 0, F.lit(1.0) - residual / total).otherwise(
        F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
