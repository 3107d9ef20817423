"""Current state over append-only history: newest batch, one alert per house, change between batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.functions.levels import severity_rank
from sensorlake.functions.scoring import root_cause
from sensorlake.sources.layers import GoldTable, Statistics, rows_of


def newest_batch(table: Statistics) -> Column:
    """Newest batch number of a table, NULL if it is empty, as a scalar subquery.

    For a stored table it comes from the last publication, without a look at the statistics.
    """
    if isinstance(table, GoldTable):
        return table.head.agg(F.max("newest_batch")).scalar()
    return table.agg(F.max("batch_id")).scalar()


def _of_batch(table: Statistics, batch_id: int | None) -> Column:
    return F.col("batch_id") == (newest_batch(table) if batch_id is None else F.lit(batch_id))


def latest(table: Statistics, batch_id: int | None = None) -> DataFrame:
    """Rows of the newest batch, or of a requested one.

    On a table partitioned by ``batch_id`` the subquery's result prunes partitions at run time.
    Each table has its own newest batch: one without alerts writes no alert rows.
    """
    return rows_of(table).where(_of_batch(table, batch_id))


def by_severity() -> list[Column]:
    """CRITICAL before WARNING, then highest risk, then event id to make the order total."""
    return [severity_rank(), F.desc("risk_score"), F.asc("event_id")]


def one_per_house(alerts: DataFrame, by: Sequence[str] = ("house_id",)) -> DataFrame:
    """The most severe alert of each house.

    Spark limits each task to one row per house before the shuffle, so a house with very many
    alerts does not reach a single task.
    """
    place = F.row_number().over(W.partitionBy(*by).orderBy(*by_severity()))
    return alerts.where(F.col("alert_status") != "NORMAL").withColumn("_place", place).where("_place = 1").drop("_place")


#: What an alert can be the most severe of: its house's alerts, those in its status, or those with a position.
FIRSTS = ("first_of_house", "first_of_status", "first_placed", "first_on_latitude")


def house_state(alerts: DataFrame) -> DataFrame:
    """The most severe alerts of each house and batch: overall, per status, and among those with a position.

    A house has at most six rows, whatever the number of its alerts, and most have one. Views take the
    rows they need by a flag of ``FIRSTS`` and do not look at the other alerts.
    """
    latitude, longitude = F.col("latitude").isNotNull(), F.col("longitude").isNotNull()
    house = ["batch_id", "house_id"]
    kinds = alerts.withColumns({"_latitude": latitude, "_placed": latitude & longitude})
    few = one_per_house(kinds, [*house, "alert_status", "_latitude", "_placed"])

    def first(*by: str) -> Column:
        return F.row_number().over(W.partitionBy(*house, *by).orderBy(*by_severity())) == 1

    flagged = few.withColumns({
        "first_of_house": first(),
        "first_of_status": first("alert_status"),
        "first_placed": F.col("_placed") & first("_placed"),
        "first_on_latitude": F.col("_latitude") & first("_latitude"),
    })
    kept = flagged.where(" OR ".join(FIRSTS)).drop("_latitude", "_placed")
    return kept.withColumn("primary_trigger", root_cause())


def firsts(alerts: Statistics, of: str, batch_id: int | None = None) -> DataFrame:
    """The rows of a batch, the newest by default, that are first in the sense ``of``, with their cause.

    A stored table has them ready; other alerts are compared here.
    """
    if isinstance(alerts, GoldTable):
        return alerts.houses.where(_of_batch(alerts, batch_id) & F.col(of))
    rows = latest(alerts, batch_id)
    if of == "first_of_status":
        found = one_per_house(rows, ["house_id", "alert_status"])
    else:
        needed = {"first_of_house": [], "first_placed": ["latitude", "longitude"], "first_on_latitude": ["latitude"]}[of]
        found = one_per_house(rows.dropna(subset=needed) if needed else rows)
    return found.withColumn("primary_trigger", root_cause())


def current_counts(alerts: Statistics, batch_id: int | None = None) -> DataFrame:
    """One row: houses in CRITICAL and in WARNING state in a batch, the newest by default.

    For a stored table they were counted as the batch was published.
    """
    if not isinstance(alerts, GoldTable):
        return house_counts(latest(alerts, batch_id))
    if batch_id is None:
        known = alerts.head.select(F.col("newest_critical").alias("critical"), F.col("newest_warning").alias("warning"))
    else:
        known = alerts.snapshots().where(F.col("batch_id") == batch_id)
    return known.agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("critical", "warning")])


def house_counts(alerts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Houses in CRITICAL and in WARNING state, each house counted once by its worst alert.

    Only the worst status matters here, so a hash aggregation replaces sorting the alerts.
    """
    worst = (
        alerts.where(F.col("alert_status") != "NORMAL")
        .groupBy(*by, "house_id")
        .agg(F.min(severity_rank()).alias("rank"))
    )
    return worst.groupBy(*by).agg(
        F.count_if(F.col("rank") == 0).alias("critical"),
        F.count_if(F.col("rank") == 1).alias("warning"),
    )


def with_previous(rows: DataFrame, order: str, values: Sequence[str], span: int = 4096) -> DataFrame:
    """Add ``previous_<value>``: the value in the row before, by the integer column ``order``.

    A window without partitions would pull the whole history into one task. Rows are windowed
    in spans of ``order`` instead; only the last row of each span, one in ``span`` at most,
    crosses into the next.
    """
    spanned = rows.withColumn("_span", F.floor(F.col(order) / span))
    inside = W.partitionBy("_span").orderBy(order)
    current = F.struct(*values)
    ends = spanned.groupBy("_span").agg(F.max_by(current, F.col(order)).alias("_end"))
    carried = ends.select("_span", F.lag("_end").over(W.orderBy("_span")).alias("_carried"))
    carried = carried.withColumnRenamed("_span", "_of")
    # Rows without a number form a span of their own, and have no place in the order.
    joined = spanned.withColumn("_before", F.lag(current).over(inside)).join(carried, F.col("_span").eqNullSafe(F.col("_of")))
    before = F.when(F.col(order).isNotNull(), F.coalesce("_before", "_carried"))
    return joined.withColumns({f"previous_{v}": before[v] for v in values}).drop("_span", "_of", "_before", "_carried")
