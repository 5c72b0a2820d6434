"""Streaming queries: readings, features and the table sink."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadcast.functions.time import with_calendar
from loadcast.operators.reshape import known_types, typed_records
from loadcast.schemas import DEMAND_RECORD, ROLLING_COLUMNS, with_rolling
from loadcast.session import materialise
from loadcast.sources.payloads import explode_in_order
from loadcast.sources.topics import decode, encode
from loadcast.store.rejects import RejectTable, judged
from loadcast.store.tables import FeatureTable
from loadcast.streaming.repair import repair_features
from loadcast.streaming.state import REACH, LatestReadingProcessor, RollingProcessor

LIVE_INTERVAL = "10 minutes"


def feature_stream(messages: DataFrame, reach: int = REACH) -> DataFrame:
    """Demand messages to feature rows: keyed state first, then the stateless calendar.

    ``revision`` orders the rows of an hour: a late message makes later hours appear again.
    Rows older than ``reach`` rows are marked ``late`` and have no features; ``to_table`` repairs.
    """
    readings = decode(messages, DEMAND_RECORD, "arrival").drop("event_time")
    readings = readings.where("region IS NOT NULL AND timestamp_ms IS NOT NULL")
    rolled = readings.groupBy("region").transformWithStateInPandas(
        statefulProcessor=RollingProcessor(reach),
        outputStructType=with_rolling(DEMAND_RECORD).add("revision", "long").add("late", "boolean"),
        outputMode="Append",
        timeMode="None",
    )
    return with_calendar(rolled)


def live_readings(payloads: DataFrame) -> DataFrame:
    """Polled payload files to the newest reading per region, only when it changed.

    Rows whose period cannot be read are counted by the observation ``periods`` and left out.
    """
    long = known_types(typed_records(explode_in_order(payloads), "seq"))
    unreadable = F.count_if(F.col("timestamp_ms").isNull()).alias("unreadable")
    long = long.observe("periods", unreadable).where("timestamp_ms IS NOT NULL")
    return long.groupBy("region").transformWithStateInPandas(
        statefulProcessor=LatestReadingProcessor(),
        outputStructType=DEMAND_RECORD,
        outputMode="Append",
        timeMode="None",
    )


def _start(writer, checkpoint: str, live: bool | str) -> StreamingQuery:
    """Live jobs poll (a text is the interval); others process what is there and stop by themselves."""
    writer = writer.option("checkpointLocation", checkpoint)
    interval = live if isinstance(live, str) else LIVE_INTERVAL
    trigger = {"processingTime": interval} if live else {"availableNow": True}
    return writer.trigger(**trigger).start()


def to_topic(
    stream: DataFrame,
    options: dict[str, str],
    checkpoint: str,
    kind: str = "kafka",
    live: bool | str = False,
) -> StreamingQuery:
    writer = encode(stream)
    if kind != "kafka" and "revision" in stream.columns:
        # Broker offsets keep the order of sending; files need it with each message.
        writer = stream.select(
            F.col("region").alias("key"),
            F.to_json(F.struct("*")).alias("value"),
            F.col("revision").alias("offset"),
        )
    writer = writer.writeStream.outputMode("append")
    if kind == "kafka":
        writer = writer.format("kafka").options(**options)
    else:
        writer = writer.format("json").option("path", options["path"])
    return _start(writer, checkpoint, live)


def to_table(
    stream: DataFrame,
    table: FeatureTable,
    checkpoint: str,
    run_id: str,
    live: bool | str = False,
    retries: int = 3,
    delay_s: float = 30.0,
) -> StreamingQuery:
    """Upsert each micro-batch; a failed batch replays under the same id and has one effect.

    Of several rows for a key the highest ``revision``, else the last to arrive, wins; both
    columns stay out of the table.  A failed write is tried again after a delay.

    Rows marked ``late`` are stored without their features, and the features of the rows
    behind them are computed again from the stored table.  Each step has its own batch id, so a replay
    goes on where it stopped.
    """
    order = [c for c in ("revision", "arrival") if c in stream.columns]

    def store(batch: DataFrame, name: str) -> None:
        if "late" not in batch.columns:
            table.upsert(batch, name, order_by=order, leave_out=order)
            return
        batch = materialise(batch, "stream-batch")
        late = batch.where("late")
        if late.isEmpty():
            table.upsert(batch, name, order_by=order, leave_out=[*order, "late"])
            return
        table.upsert(batch.where("NOT late"), name, order_by=order, leave_out=[*order, "late"])
        bare = late.drop(*ROLLING_COLUMNS)
        table.upsert(bare, f"{name}-late", order_by=order, leave_out=[*order, "late"])
        repair_features(table, late, f"{name}-repair")

    def write(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(retries + 1):
            try:
                store(batch, f"{run_id}-{batch_id}")
                return
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(delay_s)

    return _start(stream.writeStream.foreachBatch(write), checkpoint, live)


def split_rejects(
    raw: DataFrame,
    regions: Iterable[str],
    rejects: RejectTable,
    use: Callable[[DataFrame, str], None],
    checkpoint: str,
    run_id: str,
    live: bool | str = False,
) -> StreamingQuery:
    """Raw demand rows, each micro-batch split in one pass: ``use`` gets the accepted rows and the
    batch's name, the others go to the reject table with their reason.

    A replayed batch has the same name; it is done again only if it had not been finished.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"{run_id}-{batch_id}"
        rejects.process(batch, name, lambda rows: use(rows, name))

    return _start(judged(raw, regions).writeStream.foreachBatch(write), checkpoint, live)


def progress(query: StreamingQuery) -> list[dict]:
    """Rows per micro-batch, newest last, of the most recent ones that Spark keeps."""
    return [
        {"batch": p["batchId"], "rows": p["numInputRows"]} for p in query.recentProgress
    ]


def observed(stream: DataFrame, name: str) -> DataFrame:
    """Pass-through tap: row count and newest event time reach the query listeners."""
    return stream.observe(
        name, F.count(F.lit(1)).alias("rows"), F.max("timestamp_ms").alias("newest_ms")
    )
