"""Feature tables, feature views and the small bookkeeping tables on shared storage."""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from loadcast.functions.time import DAY_MS, utc_date
from loadcast.operators import joins
from loadcast.operators.ranges import TimeRange
from loadcast.operators.series import Series
from loadcast.session import (
    create_text,
    list_names,
    materialise,
    path_exists,
    read_text,
    remove,
)


ROWS, COUNTS, LAST = "_rows", "_counts", "_last"


class PublishConflict(RuntimeError):
    """Another writer published a version first; the batch can be tried again."""


@dataclass(frozen=True)
class TableMeta:
    name: str
    version: int
    primary_key: list[str]
    event_time: str


@dataclass(frozen=True)
class Manifest:
    """One published state of a table: for each date the folder that holds it."""

    number: int
    meta: dict
    schema: str | None
    batch: str | None
    dates: dict[str, str]

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema)) if self.schema else StructType()


class FeatureTable:
    """Versioned Parquet table by event date, one row per primary key and event time.

    Files are never changed.  ``upsert`` writes the whole new content of the touched dates to new
    folders, with a summary beside it, and then publishes a manifest that names a folder for
    each date.  Manifests are numbered; the highest number is the table.  A manifest appears by one
    rename that doesn't overwrite, so a reader sees one version or the next, a crash at any point
    leaves the last version (and folders nobody names, see ``expire``), and of two writers
    one gets ``PublishConflict``.  A manifest carries its batch id: a replayed batch is skipped.

    The summary has a row for each key and date: rows (``_rows``), values of each column
    (``_counts``) and the last row (``_last``).  Look-ups into the past read it instead of the rows.

    The schema is part of the manifest.  A batch's columns are cast to it; columns that a batch
    lacks keep their stored values, new columns are added to the table (NULL in older rows).
    """

    def __init__(self, spark: SparkSession, root: str, meta: TableMeta):
        self.spark, self.meta = spark, meta
        self.base = f"{root.rstrip('/')}/{meta.name}_v{meta.version}"

    @classmethod
    def get_or_create(
        cls,
        spark: SparkSession,
        root: str,
        name: str,
        version: int,
        primary_key: str | list[str],
        event_time: str = "timestamp_ms",
    ) -> FeatureTable:
        """The stored keys win over the arguments; ``primary_key`` may be a comma list."""
        if isinstance(primary_key, str):
            primary_key = [k.strip() for k in primary_key.split(",")]
        table = cls(spark, root, TableMeta(name, version, primary_key, event_time))
        table._publish(Manifest(0, asdict(table.meta), None, None, {}))
        return cls.get(spark, root, name, version)

    @classmethod
    def get(cls, spark: SparkSession, root: str, name: str, version: int) -> FeatureTable:
        probe = cls(spark, root, TableMeta(name, version, [], ""))
        return cls(spark, root, TableMeta(**probe.manifest(0).meta))

    @property
    def keys(self) -> list[str]:
        return list(dict.fromkeys([*self.meta.primary_key, self.meta.event_time]))

    def _numbers(self) -> list[int]:
        names = list_names(self.spark, f"{self.base}/manifests")
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json"))

    def _manifest_path(self, number: int) -> str:
        return f"{self.base}/manifests/{number:010d}.json"

    def manifest(self, number: int | None = None) -> Manifest:
        """The published state of that number, or the latest."""
        if number is None:
            number = max(self._numbers())
        return Manifest(**json.loads(read_text(self.spark, self._manifest_path(number))))

    def _publish(self, manifest: Manifest) -> bool:
        text = json.dumps(asdict(manifest))
        return create_text(self.spark, self._manifest_path(manifest.number), text)

    def exists(self) -> bool:
        """Whether any date is published."""
        return bool(self.manifest().dates)

    def versions(self) -> DataFrame:
        """A row per published state that is still there: number, batch and its dates."""
        rows = [(m.number, m.batch, len(m.dates)) for m in map(self.manifest, self._numbers())]
        return self.spark.createDataFrame(rows, "number long, batch string, dates long")

    def _folders(
        self,
        manifest: Manifest,
        kind: str,
        schema: StructType,
        dates: list[str],
        spark: SparkSession | None = None,
    ) -> DataFrame:
        """Rows of some dates of a published state, with ``event_date``."""
        spark = spark or self.spark
        schema = StructType([*schema.fields, StructField("event_date", DateType())])
        if not dates:
            return spark.createDataFrame([], schema)
        paths = [
            f"{self.base}/{kind}/event_date={d}/_publish={manifest.dates[d]}" for d in sorted(dates)
        ]
        base = f"{self.base}/{kind}"
        return spark.read.schema(schema).option("basePath", base).parquet(*paths).drop("_publish")

    def _between(self, manifest: Manifest, window: TimeRange | None) -> list[str]:
        if window is None:
            return list(manifest.dates)
        first, last = _date_of(window.start_ms), _date_of(window.end_ms)
        return [d for d in manifest.dates if first <= _key(d) <= last]

    def read(self, window: TimeRange | None = None, number: int | None = None) -> DataFrame:
        """All columns, of the latest or an older published state; a time range reads its dates."""
        manifest = self.manifest(number)
        dates = self._between(manifest, window)
        rows = self._folders(manifest, "data", manifest.columns, dates)
        if window is not None and manifest.schema:
            rows = rows.filter(F.col("event_date").between(*_bounds(window)))
            rows = rows.filter(window.contains(self.meta.event_time))
        return rows.drop("event_date")

    def read_dates(self, dates: list[str], number: int | None = None) -> DataFrame:
        """All columns and ``event_date`` of the dates that are there."""
        manifest = self.manifest(number)
        there = [d for d in dates if d in manifest.dates]
        return self._folders(manifest, "data", manifest.columns, there)

    def _summary_schema(self, columns: StructType) -> StructType:
        counts = StructType([StructField(c, LongType()) for c in columns.names])
        keys = [columns[k] for k in self.meta.primary_key if k != self.meta.event_time]
        return StructType([*keys, StructField(ROWS, LongType()), StructField(COUNTS, counts),
                           StructField(LAST, columns)])

    def summary(self, window: TimeRange | None = None, number: int | None = None) -> DataFrame:
        """A row per key and date: rows, values by column, and the last row of the date."""
        manifest = self.manifest(number)
        schema = self._summary_schema(manifest.columns)
        return self._folders(manifest, "summary", schema, self._between(manifest, window))

    def read_with_past(self, window: TimeRange, reach_ms: int | None = None) -> DataFrame:
        """Rows of a range, and of each key the last row before the range's first date.

        The past comes from the summary: a row per key and date at most, of dates within ``reach_ms``.
        Rows of the first date before the range are included.
        """
        first = _date_of(window.start_ms) * DAY_MS
        rows = self.read(TimeRange(first, window.end_ms))
        low = -(2**62) if reach_ms is None else window.start_ms - reach_ms
        past = self.summary(TimeRange(low, first - 1)).filter(F.col("event_date") < _as_date(first))
        keys = [k for k in self.meta.primary_key if k != self.meta.event_time]
        latest = F.max_by(LAST, "event_date").alias(LAST)
        return rows.unionByName(past.groupBy(*keys).agg(latest).select(f"{LAST}.*"))

    def upsert(
        self,
        batch: DataFrame,
        batch_id: str,
        order_by: list[str] | None = None,
        leave_out: list[str] | None = None,
    ) -> None:
        """Insert or replace rows by key; of equal keys in the batch the highest order wins.

        ``leave_out`` names columns that only order the batch.  A row without event time fails the
        batch.
        """
        spark = batch.sparkSession
        done = f"{self.base}/done/{batch_id}"
        if path_exists(spark, done):
            return
        current = self.manifest()
        if current.batch != str(batch_id):
            self._write(spark, batch, str(batch_id), current, order_by or [], leave_out or [])
        # Only the latest manifest's batch can lack its mark.
        create_text(spark, done, str(batch_id))

    def _write(
        self,
        spark: SparkSession,
        batch: DataFrame,
        batch_id: str,
        current: Manifest,
        order_by: list[str],
        leave_out: list[str],
    ) -> None:
        number = current.number + 1
        folder = f"{number:010d}-{uuid.uuid4().hex[:12]}"
        content = batch.drop(*leave_out)
        schema = current.columns
        for field in content.schema:
            if field.name not in schema.names:
                schema = schema.add(field.name, field.dataType)
        latest = self._merged(spark, batch, content.columns, schema, current, order_by)
        rows = latest.withColumn("_publish", F.lit(folder))
        (
            # Dates go to few tasks, and AQE splits a date that is too large for one.
            rows.hint("rebalance", "event_date")
            .write.mode("append")
            .partitionBy("event_date", "_publish")
            .parquet(f"{self.base}/data")
        )
        dates = {
            d: folder
            for d in self._parts(f"{self.base}/data", "event_date=")
            if path_exists(spark, f"{self.base}/data/event_date={d}/_publish={folder}")
        }
        manifest = Manifest(
            number, current.meta, schema.json(), batch_id, {**current.dates, **dates}
        )
        self._summarise(spark, manifest, list(dates), folder)
        if not self._publish(manifest):
            raise PublishConflict(f"{self.meta.name}: version {number} is there already")

    def _summarise(
        self, spark: SparkSession, manifest: Manifest, dates: list[str], folder: str
    ) -> None:
        columns = manifest.columns.names
        keys = [k for k in self.meta.primary_key if k != self.meta.event_time]
        rows = self._folders(manifest, "data", manifest.columns, dates, spark)
        summary = rows.groupBy(*keys, "event_date").agg(
            F.count(F.lit(1)).alias(ROWS),
            F.struct(*[F.count(c).alias(c) for c in columns]).alias(COUNTS),
            F.max_by(F.struct(*columns), self.meta.event_time).alias(LAST),
        )
        summary = summary.withColumn("_publish", F.lit(folder)).hint("rebalance", "event_date")
        parts = ["event_date", "_publish"]
        summary.write.mode("append").partitionBy(*parts).parquet(f"{self.base}/summary")

    def _merged(
        self,
        spark: SparkSession,
        batch: DataFrame,
        names: list[str],
        schema: StructType,
        current: Manifest,
        order_by: list[str],
    ) -> DataFrame:
        """New content of the dates that the batch touches."""
        time_column = F.col(self.meta.event_time)
        missing = F.raise_error(F.lit(f"{self.meta.name}: a row has no {self.meta.event_time}"))
        date = F.when(time_column.isNull(), missing.cast("date")).otherwise(
            utc_date(self.meta.event_time)
        )
        merge = bool(current.dates)
        cast = {c: F.col(c).cast(schema[c].dataType) for c in names}
        incoming = batch.withColumns(cast).withColumn("event_date", date)
        rows = incoming.withColumn("_new", F.lit(1))
        if merge:
            # Read twice below: its dates first, then its rows.  Written once, so that neither
            # a source nor a stateful step runs again, also when executors are lost.
            incoming = materialise(incoming, "batch")
            touched = incoming.select(F.col("event_date").cast("string")).distinct().collect()
            dates = [d[0] for d in touched if d[0] in current.dates]
            stored = self._folders(current, "data", schema, dates, spark)
            rows = incoming.withColumn("_new", F.lit(1)).unionByName(
                stored.withColumn("_new", F.lit(0)), allowMissingColumns=True
            )
        given = [c for c in names if c not in self.keys]
        absent = [c for c in schema.names if c not in self.keys and c not in given]
        # Without an order column the row itself decides, so that a replay gives the same.
        rank = F.struct("_new", *order_by, F.xxhash64("event_date", *given))
        picked = [F.max_by(F.struct("event_date", *given), rank).alias("_row")]
        if absent and merge:
            old = F.when(F.col("_new") == 0, F.lit(1))
            picked.append(F.max_by(F.struct(*absent), old).alias("_old"))
        latest = rows.groupBy(*self.keys).agg(*picked)
        parts = ["_row.*", "_old.*"][: len(picked)]
        latest = latest.select(*self.keys, *parts)
        for name in absent if not merge else ():
            latest = latest.withColumn(name, F.lit(None).cast(schema[name].dataType))
        return latest.select(*schema.names, "event_date")

    def _parts(self, path: str, label: str) -> list[str]:
        names = list_names(self.spark, path)
        return [n.removeprefix(label) for n in names if n.startswith(label)]

    def expire(self, keep: int = 1) -> int:
        """Forget all but the last ``keep`` states and delete folders that none of these names.

        Run it while nobody writes.  Returns the number of deleted folders.
        """
        numbers = self._numbers()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        named = {(d, folder) for m in kept for d, folder in m.dates.items()}
        for number in numbers[1:-keep]:
            remove(self.spark, self._manifest_path(number))
        deleted = 0
        for kind in ("data", "summary"):
            for date in self._parts(f"{self.base}/{kind}", "event_date="):
                path = f"{self.base}/{kind}/event_date={date}"
                for folder in self._parts(path, "_publish="):
                    if (date, folder) not in named:
                        remove(self.spark, f"{path}/_publish={folder}")
                        deleted += 1
        return deleted


def _date_of(ms: int) -> int:
    """Day number of an instant; dates end with the year 9999."""
    return max(-719_162, min(2_932_896, ms // DAY_MS))


def _as_date(ms: int) -> Column:
    return F.date_from_unix_date(F.lit(_date_of(ms)))


def _bounds(window: TimeRange) -> tuple[Column, Column]:
    return _as_date(window.start_ms), _as_date(window.end_ms)


def _key(date: str) -> int:
    return (datetime.date.fromisoformat(date) - datetime.date(1970, 1, 1)).days


@dataclass(frozen=True)
class ViewMeta:
    """Definition of a feature view: a point-in-time join of two tables."""

    name: str
    version: int
    left: str
    left_version: int
    right: str
    right_version: int
    prefix: str = "weather_"
    tolerance_ms: int | None = None


class FeatureStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str, version: int) -> FeatureTable:
        return FeatureTable.get(self.spark, self.root, name, version)

    @property
    def _views(self) -> str:
        return f"{self.root}/views"

    def list_views(self, name: str | None = None) -> DataFrame:
        schema = (
            "name string, version int, left string, left_version int, right string, "
            "right_version int, prefix string, tolerance_ms long"
        )
        if not path_exists(self.spark, self._views):
            return self.spark.createDataFrame([], schema)
        views = self.spark.read.schema(schema).json(f"{self._views}/*")
        return views if name is None else views.filter(F.col("name") == name)

    def get_or_create_view(self, meta: ViewMeta) -> ViewMeta:
        path = f"{self._views}/{meta.name}_v{meta.version}"
        create_text(self.spark, path, json.dumps(asdict(meta)))
        return ViewMeta(**json.loads(read_text(self.spark, path)))

    def read_view(self, meta: ViewMeta, window: TimeRange | None = None) -> DataFrame:
        """Lazy; a range reads its dates of both tables and the right table's summary before."""
        left = self.table(meta.left, meta.left_version)
        right = self.table(meta.right, meta.right_version)
        if window is None:
            known = right.read()
        else:
            known = right.read_with_past(window, meta.tolerance_ms)
        series = Series(left.meta.primary_key[0], left.meta.event_time)
        return joins.asof_join(left.read(window), known, series, meta.prefix, meta.tolerance_ms)


class Ledger:
    """Append-only rows: run parameters and metrics, registered models."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    RUN_SCHEMA = "run_id string, region string, name string, value string"
    MODEL_SCHEMA = (
        "name string, region string, is_tuned boolean, version string, status string, "
        "run_id string, path string"
    )

    def log_parameters(self, run_id: str, values: dict) -> None:
        rows = [(run_id, None, k, str(v)) for k, v in values.items()]
        self._append(self.spark.createDataFrame(rows, self.RUN_SCHEMA), "runs")

    def log_metrics(self, metrics: DataFrame) -> None:
        """(run_id, region, name, value) rows, one per metric."""
        self._append(metrics, "runs")

    def register(self, models: list[tuple]) -> None:
        """Rows of ``MODEL_SCHEMA``, one per registered region."""
        if models:
            self._append(self.spark.createDataFrame(models, self.MODEL_SCHEMA), "models")

    def _append(self, rows: DataFrame, name: str) -> None:
        # Bookkeeping: a handful of rows per run, so one file.
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def runs(self) -> DataFrame:
        return self._read("runs", self.RUN_SCHEMA)

    def models(self) -> DataFrame:
        return self._read("models", self.MODEL_SCHEMA)
