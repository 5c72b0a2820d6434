"""Per-key state of the streaming jobs.

The processors see one micro-batch of one region at a time.  Its size is set by the rate
limit of the source (``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``); where it cuts does not
change what is stored in the end, as every row carries its order of arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loadcast.functions.time import DAY_MS
from loadcast.schemas import (
    DEMAND_RECORD,
    LAGS,
    METRICS,
    ROLLING_COLUMNS,
    ROLLING_WINDOWS,
)

HISTORY = max(*ROLLING_WINDOWS, *(n + 1 for n in LAGS))
REACH = 720
BLOCK = 4096
HOUR_VALUES = ("demand", "human_read_period", "forecast", "ti", "ng", "arrival")
DAY_STATE = (
    "timestamp_ms array<long>, demand array<double>, human_read_period array<string>, "
    "forecast array<long>, ti array<long>, ng array<long>, arrival array<string>"
)


def _block(series: np.ndarray, start: int) -> dict[str, np.ndarray]:
    """Features of ``series[start:]``; NaN is none."""
    out = {}
    for n in ROLLING_WINDOWS:
        mean, median = np.full(len(series), np.nan), np.full(len(series), np.nan)
        if len(series) >= n:
            frames = np.lib.stride_tricks.sliding_window_view(series, n)
            mean[n - 1 :], median[n - 1 :] = frames.mean(axis=1), np.median(frames, axis=1)
        out[f"mean_{n}"], out[f"median_{n}"] = mean[start:], median[start:]
    for n in LAGS:
        lag = np.full(len(series), np.nan)
        lag[n:] = series[: max(len(series) - n, 0)]
        out[f"lag_{n}h"] = lag[start:]
    return out


def rolling_features(past: np.ndarray, new: np.ndarray) -> dict[str, np.ndarray]:
    """Features of the ``new`` values after at most ``HISTORY`` earlier ones; NaN is none.

    The medians copy each frame, so long inputs go through in blocks.
    """
    series = np.concatenate([past, new])
    parts = []
    for start in range(len(past), max(len(series), len(past) + 1), BLOCK):
        low = max(0, start - HISTORY)
        parts.append(_block(series[low : start + BLOCK], start - low))
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


class RollingProcessor(StatefulProcessor):
    """Rolling and lag features of each row, right for any order of arrival.

    The state maps the days of a region's latest rows to their hours, values and arrival: ``HISTORY``
    rows more than the ``reach`` rows whose features it can compute, and the rest of the oldest
    day.  A micro-batch writes the days it changes and removes those that fall out.  Of several rows for an hour the one
    that arrived last counts, in whatever order batches bring them.  A late or corrected hour is
    inserted, and the rows behind it whose features it changes are emitted again under a higher
    ``revision``.  Rows without demand pass with NULL features and are no part of the series.

    Rows older than the reach are emitted as ``late``, without features: the sink stores them and
    computes the features behind them from the stored table (``streaming.repair``).
    """

    def __init__(self, reach: int = REACH) -> None:
        self._reach = reach

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._days = handle.getMapState("days", "day long", DAY_STATE)
        self._mark = handle.getValueState("mark", "cut boolean, revision long")

    def _stored(self) -> pd.DataFrame:
        found = [row for _, lists in self._days.iterator() for row in zip(*lists, strict=True)]
        return _typed(pd.DataFrame(found, columns=["timestamp_ms", *HOUR_VALUES]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values):
        # The rate limit of the source bounds the micro-batch.
        batch = _typed(pd.concat(list(rows), ignore_index=True)[["timestamp_ms", *HOUR_VALUES]])
        known = self._stored().sort_values("timestamp_ms", ignore_index=True)
        cut, revision = self._mark.get() if self._mark.exists() else (False, 0)
        ties = ["arrival", *(c for c in HOUR_VALUES if c != "arrival")]
        fresh = batch.sort_values(ties, kind="stable").drop_duplicates("timestamp_ms", keep="last")
        before = fresh["timestamp_ms"].map(known.set_index("timestamp_ms")["arrival"])
        fresh = fresh[before.isna() | (fresh["arrival"] > before.fillna(""))]
        is_late = pd.Series(False, fresh.index)
        if cut:
            # Without the rows that have left, features are whole from the ``HISTORY``-th row on.
            whole = known.loc[known["demand"].notna(), "timestamp_ms"]
            horizon = whole.iloc[min(HISTORY, len(whole)) - 1]
            is_late = fresh["timestamp_ms"] <= horizon
        late = fresh[is_late]
        kept = fresh[fresh["timestamp_ms"] >= known["timestamp_ms"].iloc[0]] if cut else fresh
        new = kept["timestamp_ms"][~is_late[kept.index]]
        rows_now = pd.concat([known[~known["timestamp_ms"].isin(kept["timestamp_ms"])], kept])
        rows_now = rows_now.sort_values("timestamp_ms", ignore_index=True)
        is_new = rows_now["timestamp_ms"].isin(new).to_numpy()
        changed = rows_now["timestamp_ms"].isin(kept["timestamp_ms"]).to_numpy()
        present = rows_now["demand"].notna().to_numpy()
        # Place in the series of each row, or of the next one for rows outside it.
        place = np.cumsum(present) - present
        values = rows_now.loc[present, "demand"].to_numpy(float)
        touched = np.zeros(len(values) + HISTORY + 1, np.int64)
        np.add.at(touched, place[changed], 1)
        sums = np.concatenate([[0], np.cumsum(touched)])
        at = np.arange(len(values))
        affected = sums[at + 1] - sums[np.maximum(at - HISTORY, 0)] > 0
        if cut:
            affected &= rows_now.loc[present, "timestamp_ms"].to_numpy() > horizon
        emitted = is_new.copy()
        emitted[np.flatnonzero(present)[affected]] = True
        features = pd.DataFrame(index=rows_now.index, columns=list(ROLLING_COLUMNS), dtype=float)
        if affected.any():
            first = int(np.flatnonzero(affected)[0])
            found = rolling_features(values[max(0, first - HISTORY) : first], values[first:])
            index = np.flatnonzero(present)[first:]
            for name, column in found.items():
                features.loc[index, name] = column
        self._keep(known, rows_now, present, changed, cut, revision + 1)
        out = pd.concat([rows_now[emitted], late], ignore_index=True)
        more = pd.concat([features[emitted], features.iloc[:0].reindex(late.index)], ignore_index=True)
        out = pd.concat([out, more], axis=1)
        out["late"] = np.arange(len(out)) >= int(emitted.sum())
        out["region"], out["revision"] = key[0], revision + 1
        out["demand"] = out["demand"].astype("Int64")
        yield out[[*DEMAND_RECORD.names, *ROLLING_COLUMNS, "revision", "late"]]

    def _keep(
        self,
        known: pd.DataFrame,
        rows: pd.DataFrame,
        present: np.ndarray,
        changed: np.ndarray,
        cut: bool,
        revision: int,
    ) -> None:
        keep = HISTORY + self._reach
        where = np.flatnonzero(present)
        start = int(where[-keep]) if len(where) > keep else 0
        # Rows without demand do not pile up where demand stays away.
        start = max(start, len(rows) - 4 * keep)
        if present[start:].sum() <= HISTORY:
            start = 0
        # Whole days leave.
        day = rows["timestamp_ms"] // DAY_MS
        first = int(day.iloc[start])
        left = rows[day >= first]
        for number, part in left.groupby(day):
            if changed[part.index].any():
                lists = [[None if pd.isna(x) else x for x in part[c]] for c in left.columns]
                self._days.updateValue((int(number),), tuple(lists))
        for number in set(known["timestamp_ms"] // DAY_MS):
            if number < first:
                self._days.removeKey((int(number),))
        self._mark.update((bool(cut or first > day.iloc[0]), revision))

    def close(self) -> None:
        pass


def _typed(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.astype({"timestamp_ms": "int64", "demand": float})
    return rows.astype({name: "Int64" for name in ("forecast", "ti", "ng")})


class LatestReadingProcessor(StatefulProcessor):
    """Emit a region's newest merged reading when it differs from the one emitted last.

    Input are typed long rows of one poll; output is at most one wide row per poll.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("reading", "reading string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values):
        batch = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        newest = batch[batch["timestamp_ms"] == batch["timestamp_ms"].max()]
        values = newest.drop_duplicates("electricity_demand_type", keep="last").set_index(
            "electricity_demand_type"
        )["electricity_demand"]
        reading = {
            "timestamp_ms": int(newest["timestamp_ms"].iloc[0]),
            "human_read_period": newest["human_read_period"].iloc[0],
            "region": key[0],
        }
        for code, name in METRICS.items():
            value = values.get(code)
            reading[name] = None if value is None or pd.isna(value) else int(value)
        text = repr(reading)
        if not self._state.exists() or self._state.get()[0] != text:
            self._state.update((text,))
            out = pd.DataFrame([reading])
            yield out.astype({name: "Int64" for name in METRICS.values()})

    def close(self) -> None:
        pass
