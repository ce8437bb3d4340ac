"""Leave: worked days, conflicts with them, and moving leave out of the way.

Leave days run from leave_start to leave_end, both included, when compared with worked days;
leave_days_count is their difference, so one less.

Whether a leave meets a worked day is read from the person's days as bits, 64 days in a number: one
row per person, no longer than the calendar, however many shifts and leaves the person has.

To move leave, leaves are reduced to requests first: one staff member may have any number of leaves,
but only as many different (start, duration) requests as the calendar allows. Each request is
answered once, and the answers are attached to the leaves.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions import day_bits
from rosterlake.functions.choices import flag
from rosterlake.operators.cleaning import distinct_staff_days
from rosterlake.operators.joins import attach

REQUEST = ["staff_id", "leave_start", "duration_days"]


def worked_days(shifts: DataFrame, leaves: DataFrame) -> DataFrame:
    """Distinct worked days of the staff that appear in the leaves."""
    staff = leaves.select("staff_id").dropna().distinct()
    return distinct_staff_days(shifts).join(staff, "staff_id", "left_semi")


def leave_end(start: Column, duration: Column, window_end: date) -> Column:
    return F.least(F.date_add(start, duration.cast("int")), F.lit(window_end))


def with_leave_window(leaves: DataFrame, window_end: date) -> DataFrame:
    end = leave_end(F.col("leave_start"), F.col("duration_days"), window_end)
    return leaves.withColumn("leave_end", end)


def with_leave_days(leaves: DataFrame) -> DataFrame:
    days = F.datediff("leave_end", "leave_start").cast("long")
    return leaves.withColumn("leave_days_count", days)


def worked_bits(worked: DataFrame) -> DataFrame:
    """staff_id and ``_worked``, the days of ``shift_date`` as a set of bits, one row per person.

    ``worked`` may name a day any number of times. Bits are added up in each task first, so what
    is shuffled are numbers per person and 64 days, never shifts; the map of a person is bounded
    by the calendar. Rows without person or day are left out.
    """
    day = F.unix_date("shift_date")
    return (
        worked.select("staff_id", day.alias("_day"))
        .dropna()
        .groupBy("staff_id", day_bits.block_of(F.col("_day")).alias("block"))
        .agg(F.bit_or(day_bits.bit_of(F.col("_day"))).alias("bits"))
        .groupBy("staff_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("_worked"))
    )


def with_conflict_flag(leaves: DataFrame, worked: DataFrame) -> DataFrame:
    """1 if a worked day lies in the leave, ends included, else 0.

    Each leave is joined once to its person's days, of which a few numbers are looked at; it is
    paired with no day. ``worked`` may name a day any number of times.
    """
    first, last = F.unix_date("leave_start"), F.unix_date("leave_end")
    meets = day_bits.any_between(F.col("_worked"), first, last)
    joined = attach(leaves, worked_bits(worked), ["staff_id"], grouped=True)
    return joined.withColumn("conflict_flag", flag(meets)).drop("_worked")


def leave_shift_conflicts(leaves: DataFrame, worked: DataFrame) -> DataFrame:
    """The leaves that contain a worked day."""
    return with_conflict_flag(leaves, worked).where("conflict_flag = 1").drop("conflict_flag")


def _free_stretches(requests: DataFrame, worked: DataFrame, window_end: date) -> DataFrame:
    """The stretches without work of each requesting staff member.

    ``free_from`` is the first free day, ``free_until`` the next worked day (null: none).
    A day before all dates opens the calendar, also for staff who never worked.
    """
    opening = requests.select("staff_id").distinct().withColumn("_day", F.lit(date(1600, 1, 1)))
    days = opening.unionByName(
        worked.where(F.col("shift_date") <= F.lit(window_end)).select(
            "staff_id", F.col("shift_date").alias("_day")
        )
    )
    in_order = Window.partitionBy("staff_id").orderBy("_day")
    return (
        days.withColumn("free_until", F.lead("_day").over(in_order))
        .withColumn("free_from", F.date_add("_day", 1))
        .where(
            (F.col("free_from") <= F.lit(window_end))
            & (F.col("free_until").isNull() | (F.col("free_until") > F.col("free_from")))
        )
        .select("staff_id", "free_from", "free_until")
    )


def leave_moves(requests: DataFrame, worked: DataFrame, window_end: date) -> DataFrame:
    """Days by which each distinct request moves forward until it meets no worked day.

    A request takes its own start if the stretch around it leaves room, else the start of the
    next stretch long enough for its duration. That is found per (staff, duration) with two
    running windows over the stretches long enough and the requests, in order of time. A
    request that would move by the limit or more stops at the limit, free or not. One that
    starts after the window's end has no day to compare and stays.
    """
    stretches = _free_stretches(requests, worked, window_end)
    room = F.datediff("free_until", "free_from")
    long_enough = (
        requests.select("staff_id", "duration_days")
        .distinct()
        .join(stretches, "staff_id")
        .where(room.isNull() | (room > F.col("duration_days")))
        .select(
            "staff_id",
            "duration_days",
            F.col("free_from").alias("_day"),
            "free_from",
            F.coalesce("free_until", F.lit(date(9999, 12, 31))).alias("free_until"),
        )
    )
    timeline = long_enough.unionByName(
        requests.withColumnRenamed("leave_start", "_day"), allowMissingColumns=True
    )
    person = Window.partitionBy("staff_id", "duration_days")
    so_far = person.orderBy("_day").rangeBetween(Window.unboundedPreceding, 0)
    onwards = person.orderBy(F.desc("_day")).rangeBetween(Window.unboundedPreceding, 0)
    start = F.col("leave_start")
    stays = F.date_add(start, F.col("duration_days").cast("int")) < F.col("_until")
    free_start = F.when(stays | (start > F.lit(window_end)), start).otherwise(F.col("_next_from"))
    moved = F.least(F.datediff(free_start, start), F.lit(rules.MAX_LEAVE_MOVES))
    return (
        timeline.withColumns(
            {
                "_until": F.max("free_until").over(so_far),
                "_next_from": F.min("free_from").over(onwards),
            }
        )
        .where("free_from IS NULL")
        .withColumnRenamed("_day", "leave_start")
        .select(*REQUEST, F.coalesce(moved, F.lit(rules.MAX_LEAVE_MOVES)).alias("moved_days"))
    )


def resolve_leave_conflicts(leaves: DataFrame, worked: DataFrame, window_end: date) -> DataFrame:
    """Move each leave to its first position without a worked day, start and end clamped to
    the window's end; adds ``moved_days``. Leaves do not avoid each other."""
    requests = leaves.select(*REQUEST).dropna().distinct()
    moves = leave_moves(requests, worked, window_end)
    attached = attach(leaves, moves, REQUEST).withColumn(
        "moved_days", F.coalesce("moved_days", F.lit(0)).cast("long")
    )
    moved_start = F.least(
        F.date_add("leave_start", F.col("moved_days").cast("int")), F.lit(window_end)
    )
    return attached.withColumn(
        "leave_start",
        F.when(F.col("moved_days") > 0, moved_start).otherwise(F.col("leave_start")),
    ).transform(with_leave_window, window_end)
