"""Rows that break a declared constraint: what they break, and which of them no table can hold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import rules, schemas
from sensorlake.functions.conditional import any_of


@dataclass(frozen=True)
class Constraint:
    """A condition on one column. A row that breaks a ``drops`` constraint goes; others are mended."""

    column: str
    reason: str
    broken: Column
    drops: bool = True

    def said(self) -> Column:
        return F.when(self.broken, F.lit(f"{self.column}: {self.reason}"))


def required(column: str) -> Constraint:
    return Constraint(column, "missing", F.col(column).isNull())


def within(column: str, low: float | None, high: float | None) -> Constraint:
    """A value outside the range; NULL is inside. The row stays, its value is blanked."""
    bounds = [F.col(column) < low] if low is not None else []
    bounds += [F.col(column) > high] if high is not None else []
    told = f"below {low}" if high is None else f"above {high}" if low is None else f"not in {low} to {high}"
    return Constraint(column, told, F.coalesce(any_of(bounds), F.lit(False)), drops=False)


def at_most(column: str, length: int) -> Constraint:
    return Constraint(column, f"longer than {length}", F.coalesce(F.length(column) > length, F.lit(False)))


def of_readings() -> list[Constraint]:
    """What the cleaned layer asks of a reading."""
    ranges = [within(column, low, high) for column, (low, high) in rules.VALID_RANGES.items()]
    return [required("house_id"), required("event_time"), *ranges, within("methane_ppm", 0, None)]


def of_statistics(table: str) -> list[Constraint]:
    """What a statistics table asks of its texts."""
    return [at_most(c, n) for c, n in schemas.TEXT_LENGTHS.items() if c in schemas.GOLD[table].names]


def reasons(constraints: Sequence[Constraint]) -> Column:
    """What a row breaks, in the order of the constraints, as text; NULL for a sound row."""
    said = F.concat_ws("; ", *[c.said() for c in constraints])
    return F.when(said != "", said)


def dropped(constraints: Sequence[Constraint]) -> Column:
    drops = [c.broken for c in constraints if c.drops]
    return any_of(drops) if drops else F.lit(False)


def rejected(rows: DataFrame, constraints: Sequence[Constraint], table: str, batch_id: int) -> DataFrame:
    """The rows that break a constraint, as they came, with what they break."""
    time = next((c for c in ("event_time", "alert_time", "snapshot_time") if c in rows.columns), None)
    known = {c: F.col(c) if c in rows.columns else F.lit(None) for c in ("event_id", "house_id", "governorate", "zone")}
    found = rows.withColumn("_reasons", reasons(constraints)).where("_reasons IS NOT NULL")
    return schemas.conform(
        found.select(
            *[value.alias(c) for c, value in known.items()],
            (F.col(time) if time else F.lit(None)).alias("event_time"),
            F.col("_reasons").alias("reasons"),
            dropped(constraints).alias("dropped"),
            F.to_json(F.struct(*rows.columns)).alias("content"),
            F.lit(table).alias("table_name"),
            F.lit(batch_id).alias("batch_id"),
        ),
        schemas.REJECTED,
    )
