"""Rolling means and medians, lags and the next-hour target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from loadcast.operators.series import Series, blocked
from loadcast.schemas import LAGS, ROLLING_COLUMNS, ROLLING_WINDOWS

LONGEST = max(ROLLING_WINDOWS)


def _frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def _averages(value: str, w: WindowSpec) -> dict[str, Column]:
    return {f"_avg_{n}": F.avg(value).over(_frame(w, n)) for n in ROLLING_WINDOWS}


def _means(seen: Column) -> dict[str, Column]:
    """Mean of the last n rows, NULL until n rows exist."""
    return {f"mean_{n}": F.when(seen >= n, F.col(f"_avg_{n}")) for n in ROLLING_WINDOWS}


def _medians(frame: Column) -> dict[str, Column]:
    """Medians of all windows from one list of the latest rows.

    A sliding percentile builds a count map per row and window; one list per row, sorted, is
    several times cheaper.
    """
    out = {}
    for n in ROLLING_WINDOWS:
        ordered = F.sort_array(frame if n == LONGEST else F.slice(frame, -n, n))
        low, high = ordered[(n - 1) // 2], ordered[n // 2]
        middle = (low.cast("double") + high.cast("double")) / 2
        out[f"median_{n}"] = F.when(F.size(frame) >= n, middle)
    return out


def _lags(value: str, w: WindowSpec) -> dict[str, Column]:
    return {f"lag_{n}h": F.lag(value, n).over(w).cast("double") for n in LAGS}


def _latest(value: str, w: WindowSpec) -> dict[str, Column]:
    return {"_latest": F.collect_list(value).over(_frame(w, LONGEST))}


def add_means(df: DataFrame, s: Series, value: str = "demand") -> DataFrame:
    def columns(w: WindowSpec) -> dict[str, Column]:
        return {**_averages(value, w), "_seen": F.count(value).over(_frame(w, LONGEST))}

    means = _means(F.col("_seen"))
    return blocked(_present(df, value), s, columns, derived=means, back=LONGEST)


def add_medians(df: DataFrame, s: Series, value: str = "demand") -> DataFrame:
    medians = _medians(F.col("_latest"))
    return blocked(
        _present(df, value), s, lambda w: _latest(value, w), derived=medians, back=LONGEST
    )


def add_lags(df: DataFrame, s: Series, value: str = "demand") -> DataFrame:
    return blocked(_present(df, value), s, lambda w: _lags(value, w), back=max(LAGS))


def add_target(df: DataFrame, s: Series, value: str = "demand") -> DataFrame:
    """Value of the next row; NULL on the last row of a series."""
    return blocked(df, s, lambda w: {"target": F.lead(value).over(w)}, ahead=True)


def add_rolling(
    df: DataFrame, s: Series, value: str = "demand", target: bool = False
) -> DataFrame:
    """All rolling features (and the target) in one pass: one shuffle, one sort.

    Rows without a value leave the series first, as frames count rows, not hours.
    """
    def columns(w: WindowSpec) -> dict[str, Column]:
        out = {**_averages(value, w), **_latest(value, w), **_lags(value, w)}
        return {**out, "target": F.lead(value).over(w)} if target else out

    derived = {**_means(F.size("_latest")), **_medians(F.col("_latest"))}
    rows = blocked(
        _present(df, value), s, columns, derived=derived, back=max(LONGEST, *LAGS), ahead=target
    )
    last = ["target"] if target else []
    kept = [c for c in df.columns if c not in (*ROLLING_COLUMNS, "target")]
    return rows.select(*kept, *ROLLING_COLUMNS, *last)


def default_rolling(df: DataFrame) -> DataFrame:
    """Feature columns of a frame without a demand column: all zero."""
    return df.withColumns({name: F.lit(0.0) for name in ROLLING_COLUMNS})


def rolling_or_default(df: DataFrame, s: Series, value: str = "demand") -> DataFrame:
    return add_rolling(df, s, value) if value in df.columns else default_rolling(df)


def _present(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull())
