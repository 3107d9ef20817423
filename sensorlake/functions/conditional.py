"""Small builders shared by the rule expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(branches: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """CASE whose first true condition wins; a NULL condition does not match."""
    case = F
    for condition, value in branches:
        case = case.when(condition, value)
    return case.otherwise(otherwise)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)
