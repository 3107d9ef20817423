"""Values as they are shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below any displayed digit, above the noise of adding doubles in a different order.
_NOISE = 1e-9


def rounded(value: Column, digits: int = 1) -> Column:
    """Round half away from zero; NULL shows as 0.

    Averages reach exact ties (x.x5) up to the noise of their summation order, which a
    cluster does not fix, so the value is moved off the tie before rounding.
    """
    known = F.coalesce(value.cast("double"), F.lit(0.0))
    return F.round(known + F.signum(known) * F.lit(_NOISE), digits)


def as_decimal(value: Column, precision: int, digits: int) -> Column:
    """Fixed-point display value; NULL stays NULL."""
    return F.when(value.isNotNull(), rounded(value, digits).cast(f"decimal({precision},{digits})"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, 0 when there is nothing to share."""
    return rounded(F.try_divide(part * F.lit(100.0), whole), digits)


def short_number(value: Column) -> Column:
    """Text of a rounded number without a trailing ``.0``; a dash if there is none."""
    return F.coalesce(F.regexp_replace(value.cast("string"), r"\.0$", ""), F.lit("—"))
