"""Turn the mappings and limits of ``rules`` into column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_lit(text) -> Column:
    """An exact number: decimals add and multiply alike in any row order."""
    return F.lit(str(text)).cast("decimal(6,2)")


def lookup(key: Column, values: dict, otherwise: Column | None = None, to=decimal_lit) -> Column:
    """The value filed under ``key``; ``otherwise`` (null if left out) for any other key."""
    found = None
    for name, value in values.items():
        condition = key == F.lit(name)
        found = F.when(condition, to(value)) if found is None else found.when(condition, to(value))
    return found.otherwise(otherwise) if otherwise is not None else found


def first_limit(value: Column, limits, top: Column, included: bool) -> Column:
    """The result of the first limit that ``value`` stays under, else ``top``.

    ``limits`` holds (limit, result) pairs, lowest limit first.
    """
    found = None
    for limit, result in limits:
        condition = value <= F.lit(limit) if included else value < F.lit(limit)
        found = F.when(condition, result) if found is None else found.when(condition, result)
    return F.when(value.isNotNull(), found.otherwise(top))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")
