"""Parquet layers: time-partitioned readings and snapshot-partitioned statistics."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from sensorlake import schemas
from sensorlake.sources.files import delete, exists, matches, names
from sensorlake.sources.snapshots import Listed, SnapshotList

#: ``part`` of the folded rows of an hour.
FOLDED = -1


def with_time_parts(df: DataFrame, time: str = "event_time") -> DataFrame:
    """Year, month, day and hour in UTC, whatever the session's zone."""
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    day = F.date_from_unix_date(F.floor(seconds / 86_400).cast("int"))
    return df.withColumns({
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "hour": F.floor(F.pmod(seconds, F.lit(86_400)) / 3600).cast("int"),
    })


_WRITE_SETTINGS = {
    # A task that writes many small partitions is bound by its number of files, not by their
    # bytes, so adaptive execution may keep tasks smaller than its usual 1 MB.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    # Spark's default, INT96, has no usable footer statistics, so time filters could skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}
_settings_lock = Lock()
_writing: dict[int, int] = {}
_before: dict[int, dict[str, str | None]] = {}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set session options; of several writes at a time the first sets them, the last restores them."""
    session = spark._jsparkSession.hashCode()
    with _settings_lock:
        if not _writing.get(session):
            _before[session] = {name: spark.conf.get(name, None) for name in values}
            for name, value in values.items():
                spark.conf.set(name, value)
        _writing[session] = _writing.get(session, 0) + 1
    try:
        yield
    finally:
        with _settings_lock:
            _writing[session] -= 1
            if not _writing[session]:
                del _writing[session]
                for name, value in _before.pop(session).items():
                    if value is None:
                        spark.conf.unset(name)
                    else:
                        spark.conf.set(name, value)


def replace_partitions(df: DataFrame, path: str, keys: tuple[str, ...]) -> None:
    """Write ``df``, replacing exactly the partitions it contains.

    Writing the same rows again leaves the table unchanged, so a replayed micro-batch cannot
    duplicate rows. Rows are rebalanced on the partition columns: few files per partition,
    and adaptive execution splits a partition that holds a large share of the rows over
    several tasks.
    """
    with _settings(df.sparkSession, _WRITE_SETTINGS):
        (
            df.hint("rebalance", *keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(path)
        )


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _hour_number(year: object, month: object, day: object, hour: object):
    return ((year * 100 + month) * 100 + day) * 100 + hour


def within(df: DataFrame, start: datetime, end: datetime, time: str = "event_time") -> DataFrame:
    """Rows with ``start <= time < end`` of a time-partitioned layer; bounds without a zone are UTC.

    A range on the time column alone does not prune, so the same range is stated on the
    partition columns, which lets Spark list and open only the hours in question.
    """
    number = _hour_number(*[F.col(part) for part in schemas.TIME_PARTS])
    utc = [_utc(start), _utc(end)]
    low, high = (_hour_number(t.year, t.month, t.day, t.hour) for t in utc)
    bounds = [F.lit(t.isoformat(sep=" ")).cast("timestamp") for t in utc]
    if isinstance(df.schema[time].dataType, TimestampNTZType):
        bounds = [F.lit(t.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz") for t in utc]
    first, last = bounds
    return df.where(number.between(low, high) & (F.col(time) >= first) & (F.col(time) < last))


def _hour_path(time: datetime, depth: int) -> str:
    """The folder of a time's year, month, day or hour."""
    return "/".join(f"{name}={value}" for name, value in zip(schemas.TIME_PARTS[:depth], time.timetuple(), strict=False))


def _next(time: datetime, depth: int) -> datetime:
    """The beginning of the year, month, day or hour after that of ``time``, which begins one."""
    if depth == 1:
        return time.replace(year=time.year + 1)
    if depth == 2:
        return time.replace(year=time.year + time.month // 12, month=time.month % 12 + 1)
    return time + timedelta(days=1) if depth == 3 else time + timedelta(hours=1)


def _folders(start: datetime, end: datetime) -> list[str]:
    """The fewest folders of whole years, months, days and hours that hold all times from ``start`` to before ``end``."""
    out = []
    time = start.replace(minute=0, second=0, microsecond=0)
    while time < end:
        begins = [time == time.replace(month=1, day=1, hour=0), time.day == 1 and time.hour == 0, time.hour == 0, True]
        depth = next(d for d in range(1, 5) if begins[d - 1] and (d == 4 or _next(time, d) <= end))
        out.append(_hour_path(time, depth))
        time = _next(time, depth)
    return out


def _utc(time: datetime) -> datetime:
    return time.replace(tzinfo=timezone.utc) if time.tzinfo is None else time.astimezone(timezone.utc)


@dataclass(frozen=True)
class GoldTable:
    """A statistics table with its rows in the list of snapshots.

    The list answers which batch is newest, or which batches lie in a span of time, so that the
    statistics themselves are only read in the partitions of those batches. It is looked up anew
    each time, as it grows with every micro-batch.
    """

    spark: SparkSession
    lake: Lake
    name: str

    @property
    def rows(self) -> DataFrame:
        return self.lake.read_gold(self.spark, self.name)

    @property
    def head(self) -> DataFrame:
        """The newest batch of the table and its time."""
        return self.lake.heads(self.spark, "gold").where(F.col("table_name") == self.name)

    def snapshots(self, since: Column | None = None) -> DataFrame:
        """The table's batches that have rows."""
        listed = self.lake.snapshots(self.spark, "gold", since)
        return listed.where((F.col("table_name") == self.name) & (F.col("row_count") > 0))

    @property
    def houses(self) -> DataFrame:
        """The most severe alerts of each house and batch, kept while the alerts were written."""
        return self.lake.read_houses(self.spark)


Statistics = DataFrame | GoldTable


def rows_of(table: Statistics) -> DataFrame:
    return table.rows if isinstance(table, GoldTable) else table


@dataclass(frozen=True)
class Lake:
    """Paths of one set of layers."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    @property
    def houses(self) -> str:
        return f"{self.root}/gold/house_alerts"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    def layer(self, name: str) -> tuple[str, StructType]:
        """Path and schema of a time-partitioned layer."""
        return {"bronze": (self.bronze, schemas.BRONZE), "silver": (self.silver, schemas.SILVER)}[name]

    def checkpoint(self, layer: str) -> str:
        return f"{self.root}/checkpoints/{layer}"

    def read_bronze(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.bronze, schemas.BRONZE)

    def read_silver(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.silver, schemas.SILVER)

    def read_gold(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, self.gold(table), schemas.GOLD[table])

    def read_houses(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.houses, schemas.HOUSE_ALERTS)

    def read_rejected(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.rejected, schemas.REJECTED)

    def gold_table(self, spark: SparkSession, table: str) -> GoldTable:
        return GoldTable(spark, self, table)

    def hours(self, spark: SparkSession, layer: str, start: datetime, end: datetime) -> DataFrame:
        """Rows of a time-partitioned layer with ``start <= event_time < end``, from the folders of that span alone.

        The folders are named after the bounds, whole days, months and years by one each, so that no
        other folder is listed, however old the layer is.
        """
        path, schema = self.layer(layer)
        start, end = _utc(start), _utc(end)
        there = [f"{path}/{folder}" for folder in _folders(start, end) if exists(spark, f"{path}/{folder}")]
        if not there:
            return spark.createDataFrame([], schema)
        return within(spark.read.schema(schema).option("basePath", path).parquet(*there), start, end)

    def register_gold(self, spark: SparkSession) -> None:
        """Make the statistics tables available to ``spark.sql`` under their own names, as they are now.

        ``gold_heads`` tells the newest batch of each table and ``gold_snapshots`` lists all; a query that
        takes its batch number from there opens the files of that batch only.
        """
        for table in schemas.GOLD:
            self.read_gold(spark, table).createOrReplaceTempView(table)
        self.heads(spark, "gold").createOrReplaceTempView("gold_heads")
        self.snapshots(spark, "gold").createOrReplaceTempView("gold_snapshots")

    # --- snapshots --------------------------------------------------------------------------

    def _list(self, layer: str) -> SnapshotList:
        return SnapshotList(f"{self.root}/snapshots/{layer}")

    def publish(self, spark: SparkSession, layer: str, written: DataFrame | list[Listed], today: date | None = None) -> None:
        """List what has been written completely: one batch, or a table (table_name, batch_id, snapshot_time, row_count) of many."""
        with _settings(spark, _WRITE_SETTINGS):
            self._list(layer).publish(spark, written, today)

    def heads(self, spark: SparkSession, layer: str) -> DataFrame:
        """The newest batch of each table of a layer."""
        return self._list(layer).heads(spark)

    def snapshots(self, spark: SparkSession, layer: str, since: Column | None = None) -> DataFrame:
        """One row per table and batch of a layer; none before the first micro-batch."""
        return self._list(layer).listed(spark, since)

    # --- numbering --------------------------------------------------------------------------

    def first_number(self, spark: SparkSession, layer: str, query_id: str) -> int:
        """The number of micro-batch 0 of a streaming query, which its checkpoint identifies.

        A new checkpoint counts its micro-batches from 0 again. Its numbers continue above those in
        the layer, so that it adds to the layer and replaces nothing; the first number is recorded,
        so that a repeated micro-batch keeps its number.
        """
        path = f"{self.root}/queries/{layer}"
        if exists(spark, path):
            known = read_table(spark, path, schemas.QUERY).where(F.col("query_id") == query_id).agg(F.min("first_number")).first()[0]
            if known is not None:
                return known
        known = [] if not exists(spark, path) else [read_table(spark, path, schemas.QUERY).agg(F.max("first_number")).first()[0]]
        known.append(self.heads(spark, layer).agg(F.max("last_batch")).first()[0])
        number = max((n + 1 for n in known if n is not None), default=0)
        # A micro-batch that was written but not listed keeps its number to itself.
        while self._taken(spark, layer, number):
            number += 1
        spark.createDataFrame([(query_id, number)], schemas.QUERY).coalesce(1).write.mode("append").parquet(path)
        return number

    def _taken(self, spark: SparkSession, layer: str, number: int) -> bool:
        if layer == "gold":
            return any(exists(spark, f"{self.gold(table)}/batch_id={number}") for table in schemas.GOLD)
        return matches(spark, f"{self.layer(layer)[0]}/year=*/month=*/day=*/hour=*/part={number}")


def layer_counts(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows per micro-batch and layer, as counted while they were written."""
    layers = [lake.snapshots(spark, layer) for layer in ("bronze", "silver", "gold")]
    listed = layers[0].unionByName(layers[1]).unionByName(layers[2])
    return listed.where("row_count > 0").select(F.col("table_name").alias("layer"), "batch_id", "row_count")


def fold_hour(spark: SparkSession, lake: Lake, layer: str, hour: datetime) -> int:
    """Fold the micro-batch folders of one closed hour (UTC) into one; returns how many.

    The newest micro-batch stays as it is, since only that one can be repeated; a late reading lands in
    a folder of its own until the next call. An interrupted call is made good by the next: a
    micro-batch that the folded rows hold already is dropped, not added again. Between the writing of
    the hour and the removal of its old folders readers see both, so call it while the hour is not read.
    """
    path, schema = lake.layer(layer)
    place = f"{path}/{_hour_path(_utc(hour), 4)}"
    newest = lake.heads(spark, layer).agg(F.max("last_batch")).first()[0]
    parts = [int(name.removeprefix("part=")) for name in names(spark, place) if name.startswith("part=")]
    closed = [part for part in parts if part != FOLDED and newest is not None and part < newest]
    if not closed:
        return 0
    wanted = [f"{place}/part={part}" for part in parts if part == FOLDED or part in closed]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*wanted)
    before = rows.where(F.col("part") == FOLDED)
    fresh = rows.where(F.col("part") != FOLDED).join(before.select("ingest_batch").distinct(), "ingest_batch", "left_anti")
    folded = before.unionByName(fresh.select(*before.columns)).withColumn("part", F.lit(FOLDED))
    staged = f"{lake.root}/folding/{layer}"
    replace_partitions(schemas.conform(folded, schema), staged, schemas.LAYER_KEYS)
    replace_partitions(spark.read.schema(schema).option("basePath", staged).parquet(f"{staged}/{_hour_path(_utc(hour), 4)}"), path, schemas.LAYER_KEYS)
    for part in closed:
        delete(spark, f"{place}/part={part}")
    delete(spark, staged)
    return len(closed)
