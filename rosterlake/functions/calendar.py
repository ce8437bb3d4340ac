"""Date and time expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.choices import flag


def surge_flag(day: Column, years=None) -> Column:
    """1 if the day lies in a surge period: of any year, or of the listed ones.

    No period crosses a year's end, so month and day decide. It is one row expression: there is
    no range join and nothing to broadcast.
    """
    month_day = F.month(day) * 100 + F.dayofmonth(day)
    periods = [
        month_day.between(first[0] * 100 + first[1], last[0] * 100 + last[1])
        for first, last in rules.SURGE_PERIODS
    ]
    in_period = reduce(or_, periods)
    return flag(in_period if years is None else F.year(day).isin(list(years)) & in_period)


def iso_year_week(day: Column) -> Column:
    """ISO year and week, as in 2025-W01 for 2024-12-30."""
    week = F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), week)


def shift_start(day: Column, shift_type: Column) -> Column:
    hour = F.when(shift_type == "Day", F.lit(rules.SHIFT_START_HOUR["Day"])).otherwise(
        F.lit(rules.SHIFT_START_HOUR["Night"])
    )
    return F.timestamp_add("HOUR", hour.cast("long"), day.cast("timestamp_ntz"))


def shift_end(start: Column, hours: Column) -> Column:
    """End of a shift, to the second, so that part hours count."""
    return F.timestamp_add("SECOND", F.round(hours * 3600).cast("long"), start)


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end) / F.lit(3600.0)
