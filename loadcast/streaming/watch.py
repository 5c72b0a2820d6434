"""What running queries report: every tap value in a ledger, and a stop after idle time."""

from __future__ import annotations

import json
import threading
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from loadcast.session import create_text, path_exists

TAP_SCHEMA = "run string, batch long, tap string, values map<string, long>"
IDLE_S, CHECK_S = 20.0, 5.0  # of a historical feature job (fixed values)


class TapLedger(StreamingQueryListener):
    """Keeps what each tap (``observed``) saw in each micro-batch, however many there are.

    A micro-batch's values are one small file named after query and batch, so a batch that is
    reported or replayed twice counts once.  Add it to the session that starts the queries.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._path = spark, f"{root.rstrip('/')}/taps"
        self._busy: dict[str, float] = {}
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        self._busy[str(event.runId)] = time.monotonic()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.numInputRows:
            self._busy[str(progress.runId)] = time.monotonic()
        for tap, values in progress.observedMetrics.items():
            known = {k: v for k, v in values.asDict().items() if isinstance(v, int)}
            row = {"run": str(progress.id), "batch": progress.batchId, "tap": tap, "values": known}
            name = f"{progress.id}-{progress.batchId:010d}-{tap}.json"
            if progress.numInputRows:
                create_text(self._spark, f"{self._path}/{name}", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def idle_s(self, query: StreamingQuery) -> float:
        """Seconds since the query last had rows, or was started."""
        now = time.monotonic()
        return now - self._busy.setdefault(str(query.runId), now)

    def wait(self, query: StreamingQuery, timeout_s: float = 60.0) -> bool:
        """Until all reports of a query that has ended are in; they arrive a little later."""
        return self._ended[str(query.runId)].wait(timeout_s)

    def taps(self) -> DataFrame:
        """(run, batch, tap, values), a row per tap and micro-batch with rows."""
        if not path_exists(self._spark, self._path):
            return self._spark.createDataFrame([], TAP_SCHEMA)
        return self._spark.read.schema(TAP_SCHEMA).json(f"{self._path}/*.json")


def run_until_idle(
    query: StreamingQuery, ledger: TapLedger, idle_s: float = IDLE_S, check_s: float = CHECK_S
) -> None:
    """Let a live query run until no rows came for ``idle_s``, then stop it between micro-batches."""
    while not query.awaitTermination(check_s):
        if ledger.idle_s(query) >= idle_s and not query.status["isTriggerActive"]:
            query.stop()
    ledger.wait(query)
