"""Removing repeated rows and stamping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 2^10 consecutive numbers, or texts that differ in their last three characters, make a block of keys
BLOCK_BITS = 10
BLOCK_TAIL = 3
# blocks are counted together in so many slots; a slot of more rows than this and four times the
# mean is crowded
SLOTS = 1 << 14
CROWDED_ROWS = 1 << 16


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key; null keys equal each other.

    With ``order_by`` the first row in that order survives, which makes the result the same
    in every run. Spark then keeps only each task's first row per key before the shuffle
    (WindowGroupLimit), so many copies of one key do not end up in one task. Without it any
    row of the key survives.
    """
    if not order_by:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def _key_block(df: DataFrame, keys: Sequence[str]) -> Column:
    """The same number for keys that are near each other: all but the end of the last key counts."""
    last = keys[-1]
    kind = df.schema[last].dataType
    if isinstance(kind, T.IntegralType):
        start = F.shiftright(F.col(last).cast("long"), BLOCK_BITS)
    elif isinstance(kind, T.StringType):
        start = F.left(F.col(last), F.greatest(F.length(last) - BLOCK_TAIL, F.lit(0)))
    else:
        start = F.col(last)
    return F.xxhash64(*keys[:-1], start)


def dedup_in_blocks(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """As ``dedup_by_key`` with an order, for tables in which most keys have few copies.

    There, taking each task's first row per key costs a sort of all rows before the shuffle and saves
    little. So rows are shuffled unsorted, by blocks of near keys: rows that are delivered together
    mostly stay together, and alike rows compress. Blocks that hold many copies go by
    ``dedup_by_key``. They are found by counting, for which the keys are read when this is called;
    at most ``SLOTS`` counts come to the driver.
    """
    placed = df.withColumn("_block", _key_block(df, keys))
    slot = F.pmod("_block", F.lit(SLOTS))
    rows = dict(placed.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).collect())
    limit = CROWDED_ROWS + 4 * sum(rows.values()) // SLOTS
    crowded = [number for number, n in rows.items() if n > limit]
    few = placed.where(~slot.isin(crowded)) if crowded else placed
    window = Window.partitionBy("_block", *keys).orderBy(*order_by)
    first = few.repartition("_block").withColumn("_row", F.row_number().over(window))
    kept = first.where("_row = 1").drop("_row")
    if crowded:
        kept = kept.unionByName(dedup_by_key(placed.where(slot.isin(crowded)), keys, order_by))
    return kept.drop("_block")


def silver_stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("silver_processed_at", F.current_timestamp())


def distinct_staff_days(shifts: DataFrame) -> DataFrame:
    """The days on which each staff member worked."""
    return shifts.select("staff_id", "shift_date").dropna().distinct()


def dedup_staff_attrs(staff: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """The staff attributes that go onto the weekly facts, one row per staff member."""
    attributes = staff.select("staff_id", "role", "salary_band", "gender", "department")
    return dedup_by_key(attributes, ["staff_id"], order_by)
