"""Raw demand rows that cannot be used, kept as data beside the rows that can."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadcast.functions.numbers import whole_number
from loadcast.functions.time import parse_period
from loadcast.schemas import METRICS
from loadcast.session import create_text, path_exists, remove

BAD_PERIOD, BAD_NUMBER = "bad period", "bad number"
UNKNOWN_TYPE, UNKNOWN_REGION = "unknown type", "unknown region"


def judged(raw: DataFrame, regions: Iterable[str]) -> DataFrame:
    """``raw`` with ``reason``: the first thing that is wrong with a row, NULL if nothing is.

    A missing value is a missing reading and accepted; text that is no integer is not.
    """
    value = F.col("value")
    known_type = F.coalesce(F.col("type").isin(*METRICS), F.lit(False))
    known_region = F.coalesce(F.col("respondent").isin(*regions), F.lit(False))
    reason = (
        F.when(parse_period("period").isNull(), BAD_PERIOD)
        .when(~known_type, UNKNOWN_TYPE)
        .when(~known_region, UNKNOWN_REGION)
        .when(value.isNotNull() & whole_number(value).isNull(), BAD_NUMBER)
    )
    return raw.withColumn("reason", reason)


class RejectTable:
    """Rejected rows by batch.

    A batch is written in one pass, its accepted and its rejected rows in folders of their own.  It
    counts once its marker is there, which comes after the accepted rows were used: a batch
    that stops in between is done again, and of several attempts at a batch one is read.
    """

    def __init__(self, spark: SparkSession, root: str, name: str = "demand"):
        self.spark = spark
        self.base = f"{root.rstrip('/')}/rejects/{name}"

    def _marker(self, batch: str) -> str:
        return f"{self.base}/batches/{quote(batch, safe='')}.batch"

    def process(
        self, rows: DataFrame, batch: str, use: Callable[[DataFrame], None] | None = None
    ) -> bool:
        """Split judged ``rows``; ``use`` gets the accepted ones, without ``reason``.

        ``use`` must be repeatable for a batch (an upsert under its name, say).  False if the batch
        had been done before; then nothing happens.
        """
        spark = rows.sparkSession
        if path_exists(spark, self._marker(batch)):
            return False
        attempt = uuid.uuid4().hex
        folder = f"{self.base}/rows/attempt={attempt}"
        marked = rows.withColumn("rejected", F.col("reason").isNotNull())
        marked.write.partitionBy("rejected").parquet(folder)
        if use is not None:
            both = spark.read.schema(marked.schema).parquet(folder)
            use(both.where("NOT rejected").drop("reason", "rejected"))
        if not create_text(spark, self._marker(batch), json.dumps({"attempt": attempt, "batch": batch})):
            remove(spark, folder)
            return False
        remove(spark, f"{folder}/rejected=false")
        return True

    def read(self, schema: StructType) -> DataFrame:
        """``batch``, ``reason`` and the columns of ``schema`` of all rejected rows."""
        spark = self.spark
        fields = StructType([*schema.fields]).add("reason", "string")
        if not path_exists(spark, f"{self.base}/batches"):
            empty = spark.createDataFrame([], fields)
            return empty.select(F.lit("").alias("batch"), "reason", *schema.names)
        done = spark.read.schema("attempt string, batch string").json(
            f"{self.base}/batches", pathGlobFilter="*.batch"
        )
        parts = StructType([*fields.fields]).add("attempt", "string").add("rejected", "boolean")
        rows = spark.read.schema(parts).parquet(f"{self.base}/rows").where("rejected")
        return rows.join(done, "attempt").select("batch", "reason", *schema.names)
