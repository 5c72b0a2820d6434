"""Keyed JSON topics, with a file twin that has the same columns.

``kafka`` needs the Spark connector package on the class path of the job; ``files`` reads and
writes the messages as JSON lines and behaves alike for every step behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadcast.functions.time import event_time
from loadcast.schemas import TOPIC_MESSAGE

BATCH_LIMITS = {
    "kafka": {"maxOffsetsPerTrigger": "500000"},
    "files": {"maxBytesPerTrigger": str(128 * 2**20)},
}
LIMITS = {"maxfilespertrigger", "maxbytespertrigger", "maxoffsetspertrigger"}


def arrival(offset: Column, time_ms: Column | None = None, path: Column | None = None) -> Column:
    """Text that sorts messages of a key in their order of arrival: time, file, place."""
    parts = [F.lpad(F.coalesce(c, F.lit(0)).cast("string"), 20, "0") for c in (time_ms, offset) if c is not None]
    if path is not None:
        parts.insert(1, path)
    return F.concat_ws("|", *parts)


def file_arrival(offset: Column) -> Column:
    """The same for rows of landed files: modification time, file, place in it."""
    meta = F.col("_metadata")
    time_ms = F.unix_millis(meta["file_modification_time"])
    return arrival(offset, time_ms, meta["file_path"])


def read_topic(
    spark: SparkSession, options: dict[str, str], kind: str = "kafka", streaming: bool = True
) -> DataFrame:
    """(key, value, arrival) text messages from the earliest offset.

    ``options``: for kafka the connector options; for files ``path`` and the reader options.
    ``arrival`` sorts the messages of a key in the order in which they were sent.  A limit per
    micro-batch is always set, as keyed state holds one batch of a key at once.
    """
    if streaming and not LIMITS & {k.lower() for k in options}:
        options = {**BATCH_LIMITS.get(kind, {}), **options}
    reader = spark.readStream if streaming else spark.read
    if kind == "kafka":
        settings = {"startingOffsets": "earliest", **options}
        raw = reader.format("kafka").options(**settings).load()
        order = arrival(F.col("offset")).alias("arrival")
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), order)
    if kind == "files":
        path = options["path"]
        rest = {k: v for k, v in options.items() if k != "path"}
        raw = reader.schema(TOPIC_MESSAGE).options(**rest).json(path)
        return raw.select("key", "value", file_arrival(F.col("offset")).alias("arrival"))
    raise ValueError(f"unknown topic kind {kind}")


def decode(messages: DataFrame, schema: StructType, *keep: str) -> DataFrame:
    """Message values as columns, with the event time of the payload; ``keep`` carries others."""
    values = messages.select(F.from_json("value", schema).alias("_v"), *keep).select("_v.*", *keep)
    return values.withColumn("event_time", event_time("timestamp_ms"))


def encode(df: DataFrame, key: str = "region") -> DataFrame:
    return df.select(F.col(key).alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_topic(df: DataFrame, options: dict[str, str], kind: str = "kafka") -> None:
    """Batch write of a finished frame; the key decides the topic partition."""
    messages = encode(df)
    if kind == "kafka":
        messages.write.format("kafka").options(**options).save()
    elif kind == "files":
        placed = messages.withColumn("offset", F.monotonically_increasing_id())
        placed.write.mode("append").json(options["path"])
    else:
        raise ValueError(f"unknown topic kind {kind}")
