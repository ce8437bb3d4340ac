"""Sets of days as bits: one long number for each 64 days in which a day is set.

A block is the number of days since 1970 divided by 64, rounded down. A set is a map from block to
bits; a calendar of ten years makes at most 58 entries. Only the blocks of the days asked for are
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_DAYS = 64


def block_of(day: Column) -> Column:
    """The block of a day number."""
    return F.shiftright(day, 6)


def bit_of(day: Column) -> Column:
    """A long number in which only the day's bit is set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), day.bitwiseAND(63))


def _blocks(first: Column, last: Column) -> Column:
    """The blocks from one day to another, none if ``last`` comes before ``first``."""
    return F.when(first <= last, F.sequence(block_of(first), block_of(last))).when(
        first > last, F.array().cast("array<int>")
    )


def any_between(days: Column, first: Column, last: Column) -> Column:
    """Whether the set holds a day from ``first`` to ``last``, both included; null or false if one
    of the three is null, false if ``last`` comes before ``first``."""

    def met(block: Column) -> Column:
        ones, start = F.lit(-1).cast("long"), block * BLOCK_DAYS
        low = F.greatest(first - start, F.lit(0))
        high = F.least(last - start, F.lit(BLOCK_DAYS - 1))
        upwards = F.call_function("shiftleft", ones, low)
        downwards = F.call_function("shiftrightunsigned", ones, F.lit(BLOCK_DAYS - 1) - high)
        return days[block].bitwiseAND(upwards).bitwiseAND(downwards) != 0

    return F.exists(_blocks(first, last), met)
