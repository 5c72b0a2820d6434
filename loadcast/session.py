"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

# Settings every job wants.  The number of shuffle partitions is left to the submitter:
# AQE coalesces downwards, so a large value is safe on a cluster.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Searches run a few fits at a time; none of them shall wait for all jobs of another.
    "spark.scheduler.mode": "FAIR",
    STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, **conf: str) -> SparkSession:
    """Session for the spark-submit jobs; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC instants; period strings are parsed and printed as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@functools.cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="loadcast-")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own: on a cluster the
    executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_scratch(spark.sparkContext.applicationId)


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for keyed streams: RocksDB state and its own partition count.

    The count is fixed in the checkpoint for the life of a stream, so it is set here and not
    taken over from whatever the batch session uses.
    """
    own = use_utc(spark.newSession())
    own.conf.set(STATE_STORE, JOB_CONF[STATE_STORE])
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared and own.conf.get("spark.checkpoint.dir", None) != shared:
        own.conf.set("spark.checkpoint.dir", shared)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Unlike executor caching this survives lost executors, and the Parquet footers give the
    planner true sizes, so later joins pick broadcast or shuffle from facts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has made, if it is there."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that appears whole or not at all; False if there is one of that name.

    The text is written under another name and renamed without overwriting, so of several
    writers of one name exactly one succeeds.
    """
    files, target = _file_system(spark, path)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    if files.exists(target):
        return False
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    keep = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), spark._jsc.hadoopConfiguration()
        )
        context.rename(draft, target, keep)
    except Py4JJavaError as error:
        told = str(error.java_exception)
        if "UnsupportedFileSystem" in told and files.rename(draft, target):
            return True
        files.delete(draft, False)
        if "FileAlreadyExists" in told or "UnsupportedFileSystem" in told:
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _file_system(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
