"""The list of what a layer holds: one row per table and micro-batch, looked up from its newest end.

Every micro-batch adds one small file, in a folder of its day and of its number within the day. Besides
its own rows it carries the head of every table: the newest batch that has rows, its time, and the
last number given. So the newest batch of each table is known from one file, however long the list is.
When a day is over its files are rolled into one, beside them, so that the list of a span of time takes
a file for each past day. Days never run backwards and are never earlier than the snapshots they list,
so a span of snapshot times is also a span of days.

A list has one writer at a time, as a layer has one streaming query.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import schemas
from sensorlake.sources.files import holds_rows, names, rename

_DAY = "listed_on="
_NUMBER = "listed_as="
_HEAD = ("newest_batch", "newest_critical", "newest_warning", "newest_time", "last_batch")


def utc_day(time: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(time.cast("timestamp")) / 86_400).cast("int"))


@dataclass(frozen=True)
class Listed:
    """What a layer holds of one table and batch; ``micros`` is the snapshot time in microseconds since 1970."""

    table_name: str
    batch_id: int | None
    micros: int | None
    row_count: int
    critical: int | None = None
    warning: int | None = None


@dataclass(frozen=True)
class Head:
    """The newest batch of a table that has rows, that batch's houses, the newest time, and the last number."""

    newest_batch: int | None = None
    newest_critical: int | None = None
    newest_warning: int | None = None
    newest_micros: int | None = None
    last_batch: int | None = None

    def after(self, other: Head) -> Head:
        """The head of both together."""

        def later(a: int | None, b: int | None) -> int | None:
            return max((x for x in (a, b) if x is not None), default=None)

        newest = later(self.newest_batch, other.newest_batch)
        own = self if newest is not None and self.newest_batch == newest else other
        return Head(
            newest, own.newest_critical, own.newest_warning, later(self.newest_micros, other.newest_micros), later(self.last_batch, other.last_batch)
        )


def _head(row: Listed) -> Head:
    if not row.row_count:
        return Head(last_batch=row.batch_id)
    return Head(row.batch_id, row.critical, row.warning, row.micros, row.batch_id)


def _heads_of(written: DataFrame) -> dict[str, Head]:
    """The heads of rows (table_name, batch_id, snapshot_time, row_count, critical, warning), one per table."""
    filled = F.when(F.col("row_count") > 0, F.col("batch_id"))
    heads = written.groupBy("table_name").agg(
        F.max(filled).alias("newest_batch"),
        F.max_by("critical", filled).alias("newest_critical"),
        F.max_by("warning", filled).alias("newest_warning"),
        F.max(F.when(F.col("row_count") > 0, F.unix_micros(F.col("snapshot_time").cast("timestamp")))).alias("newest_micros"),
        F.max("batch_id").alias("last_batch"),
    )
    return {row.table_name: Head(*row[1:]) for row in heads.collect()}


@dataclass(frozen=True)
class SnapshotList:
    """The list of one layer below a folder."""

    root: str

    @property
    def _published(self) -> str:
        return f"{self.root}/published"

    @property
    def _rolled(self) -> str:
        return f"{self.root}/rolled"

    def _days(self, spark: SparkSession, path: str) -> list[str]:
        return [name.removeprefix(_DAY) for name in names(spark, path) if name.startswith(_DAY)]

    def _newest(self, spark: SparkSession) -> str | None:
        """The folder of the last publication, found by names."""
        for day in reversed(self._days(spark, self._published)):
            place = f"{self._published}/{_DAY}{day}"
            for name in reversed(names(spark, place)):
                if holds_rows(spark, f"{place}/{name}"):
                    return f"{place}/{name}"
        return None

    def heads(self, spark: SparkSession) -> DataFrame:
        """(table_name, newest_batch, newest_critical, newest_warning, newest_time, last_batch) from the last publication, the same in all rows of a table."""
        newest = self._newest(spark)
        columns = ("table_name", *_HEAD)
        if newest is None:
            return spark.createDataFrame([], schemas.SNAPSHOT).select(*columns)
        return spark.read.schema(schemas.SNAPSHOT).parquet(newest).select(*columns)

    def publish(self, spark: SparkSession, written: DataFrame | list[Listed], today: date | None = None) -> None:
        """List what is written completely: the rows of a batch, or a table (table_name, batch_id, snapshot_time, row_count) of many.

        The table may have the counts of houses, ``critical`` and ``warning``, as well. The last step of a
        micro-batch; a repeated one is listed again, which readers even out.
        """
        if isinstance(written, DataFrame):
            missing = {c: F.lit(None).cast("long") for c in ("critical", "warning") if c not in written.columns}
            written = written.withColumns(missing).persist()
        try:
            heads = {row.table_name: Head(*row[1:]) for row in self._known(spark)}
            if isinstance(written, DataFrame):
                fresh = list(_heads_of(written).items())
            else:
                fresh = [(row.table_name, _head(row)) for row in written]
            for table, head in fresh:
                heads[table] = head.after(heads.get(table, Head()))
            days = self._days(spark, self._published)
            newest = [datetime.fromtimestamp(h.newest_micros // 10**6, timezone.utc).date().isoformat() for h in heads.values() if h.newest_micros is not None]
            day = max([(today or datetime.now(timezone.utc).date()).isoformat(), *days[-1:], *newest])
            place = f"{self._published}/{_DAY}{day}"
            last = names(spark, place)[-1:]
            number = 1 + int(last[0].removeprefix(_NUMBER)) if last else 0
            rows = schemas.conform(self._with_heads(spark, heads, written), schemas.SNAPSHOT)
            rows.coalesce(1).write.mode("overwrite").parquet(f"{place}/{_NUMBER}{number:09d}")
        finally:
            if isinstance(written, DataFrame):
                written.unpersist()
        self._roll(spark, day)

    def _known(self, spark: SparkSession) -> list:
        """(table_name, newest_batch, newest_critical, newest_warning, micros, last_batch) of the last publication."""
        shown = [F.unix_micros("newest_time") if c == "newest_time" else F.col(c) for c in ("table_name", *_HEAD)]
        return self.heads(spark).select(*shown).collect() if self._newest(spark) else []

    @staticmethod
    def _with_heads(spark: SparkSession, heads: dict[str, Head], written: DataFrame | list[Listed]) -> DataFrame:
        """The rows with their tables' heads; a table without rows has one row for its head."""
        shape = "table_name string, newest_batch long, newest_critical long, newest_warning long, newest_micros long, last_batch long"
        known = [(table, h.newest_batch, h.newest_critical, h.newest_warning, h.newest_micros, h.last_batch) for table, h in heads.items()]
        if isinstance(written, DataFrame):
            rows = spark.createDataFrame(known, shape).join(written, "table_name", "left")
        else:
            listed = {row.table_name: row for row in written}
            nothing = (None,) * 5
            rows = spark.createDataFrame(
                [(*k, *((x.batch_id, x.micros, x.row_count, x.critical, x.warning) if (x := listed.get(k[0])) else nothing)) for k in known],
                f"{shape}, batch_id long, micros long, row_count long, critical long, warning long",
            ).withColumn("snapshot_time", F.timestamp_micros("micros"))
        return rows.withColumn("newest_time", F.timestamp_micros("newest_micros"))

    def _roll(self, spark: SparkSession, today: str) -> None:
        """Put the files of every day before ``today`` into one, beside them."""
        rolled = set(self._days(spark, self._rolled))
        for day in self._days(spark, self._published):
            if day < today and day not in rolled:
                # Written aside, so that the day's folder appears with its file.
                aside = f"{self._rolled}/_{uuid4().hex}"
                rows = self._read(spark, [f"{self._published}/{_DAY}{day}"], self._published)
                self._evened(rows).coalesce(1).write.parquet(aside)
                rename(spark, aside, f"{self._rolled}/{_DAY}{day}")

    @staticmethod
    def _read(spark: SparkSession, paths: list[str], base: str) -> DataFrame:
        return spark.read.schema(schemas.LISTED).option("basePath", base).parquet(*paths)

    @staticmethod
    def _evened(rows: DataFrame) -> DataFrame:
        """One row per table and batch; rows that only carry a head go."""
        listed = rows.where("row_count IS NOT NULL").groupBy("table_name", "batch_id")
        return listed.agg(*[F.max(c).alias(c) for c in ("snapshot_time", "row_count", "critical", "warning")])

    def listed(self, spark: SparkSession, since: Column | None = None) -> DataFrame:
        """One row per table and batch, from a file per past day and those of the current one.

        ``since`` is a snapshot time; days that cannot hold it are not opened.
        """
        rolled = set(self._days(spark, self._rolled))
        open_ = [day for day in self._days(spark, self._published) if day not in rolled]
        found = []
        if rolled:
            found.append(self._read(spark, [self._rolled], self._rolled))
        if open_:
            found.append(self._read(spark, [f"{self._published}/{_DAY}{day}" for day in open_], self._published))
        if not found:
            return self._evened(spark.createDataFrame([], schemas.LISTED))
        rows = reduce(DataFrame.unionByName, [part.select(*schemas.LISTED.names) for part in found])
        if since is not None:
            rows = rows.where((F.col("listed_on") >= utc_day(since)) & (F.col("snapshot_time") >= since))
        return self._evened(rows)
