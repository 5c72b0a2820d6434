"""A few long driver calls at a time, each with its own Spark jobs and a time limit."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

OK, FAILED, TIMED_OUT = "ok", "failed", "timed out"
GRACE_S = 30.0
CHECK_S = 0.2


@dataclass
class Outcome:
    """What became of a call: its value, or the message of its error."""

    status: str
    value: Any = None
    message: str = ""


@dataclass
class _Run:
    tag: str
    since: float = field(default_factory=time.monotonic)
    outcome: Outcome | None = None
    cancelled: bool = False


def run_bounded(
    spark: SparkSession,
    calls: dict[str, Callable[[], Any]],
    parallel: int = 2,
    limit_s: float | None = None,
    pool: str = "bounded",
    grace_s: float = GRACE_S,
) -> dict[str, Outcome]:
    """Outcome of every call, in the order of ``calls``; none of them stops the others.

    ``parallel`` calls run at a time.  Their jobs share the scheduler pool ``pool`` (it takes effect
    where ``spark.scheduler.mode`` is FAIR) and carry a tag per call.  The jobs of a call that runs
    longer than ``limit_s`` are cancelled by that tag, again and again, as a call may start the
    next job in between.  A call that has not ended ``grace_s`` later is left behind, so that its
    place is free for the next one.
    """
    context = spark.sparkContext
    changed = threading.Event()
    label = uuid.uuid4().hex[:8]
    waiting = list(enumerate(calls.items()))
    running: dict[str, _Run] = {}
    outcomes: dict[str, Outcome] = {}

    def start(name: str, call: Callable[[], Any], run: _Run) -> None:
        def work() -> None:
            context.setLocalProperty("spark.scheduler.pool", pool)
            context.addJobTag(run.tag)
            try:
                run.outcome = Outcome(OK, call())
            except Exception as error:
                status = TIMED_OUT if run.cancelled else FAILED
                run.outcome = Outcome(status, message=str(error).split("\n", 1)[0])
            finally:
                changed.set()

        running[name] = run
        threading.Thread(target=inheritable_thread_target(spark)(work), daemon=True).start()

    while waiting or running:
        while waiting and len(running) < max(1, parallel):
            number, (name, call) = waiting.pop(0)
            start(name, call, _Run(f"{pool}-{label}-{number}"))
        changed.wait(CHECK_S)
        changed.clear()
        for name, run in list(running.items()):
            spent = time.monotonic() - run.since
            if run.outcome is not None:
                outcomes[name] = run.outcome
            elif limit_s is not None and spent > limit_s:
                run.cancelled = True
                context.cancelJobsWithTag(run.tag)
                if spent > limit_s + grace_s:
                    outcomes[name] = Outcome(TIMED_OUT, message="left behind")
            if name in outcomes:
                del running[name]
    return {name: outcomes[name] for name in calls}
