"""Columns of a shift that depend on the staff member's other shifts.

A window over all shifts of one staff member would put a hot staff member into one task. So the
shift before in time comes from one order over all shifts, cut into ranges of equal size
(``numbering.with_row_before``). For streaks and flips, shifts are first reduced to days or to blocks
(staff, day, 2^16 consecutive ids); windows over a staff member run on days, of which a calendar
has few thousand, and the answers go back to the shifts by block. ``with_history`` takes these ways
for people with more than 2^16 shifts only; the others' shifts fit one task each.

Shifts without a staff id or date belong to nobody's history; their flags are 0.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.calendar import hours_between
from rosterlake.functions.choices import flag
from rosterlake.functions.ids import id_number
from rosterlake.operators.cleaning import distinct_staff_days
from rosterlake.operators.joins import attach
from rosterlake.operators.numbering import with_row_before

DAY = ["staff_id", "shift_date"]
BLOCK_BITS = 16
_SHIFT = ["timesheet_id", *DAY, "shift_start", "shift_end", "shift_type"]
_WORKING = ["_no", "_block", "_mark", "_night_before", "_before", "_day_before"]


def _with_block(shifts: DataFrame) -> DataFrame:
    """``_no``: the running number of the shift; ``_block``: its block of numbers.

    An id that does not end in digits is numbered by its hash, so that blocks stay small; ids
    that share a number are told apart by the id itself. Shifts without an id make a block of
    their own.
    """
    by_hash = F.pmod(F.xxhash64("timesheet_id"), F.lit(1 << 62))
    number = F.coalesce(id_number(shifts, "timesheet_id"), F.when(F.col("timesheet_id").isNotNull(), by_hash))
    numbered = shifts.withColumn("_no", number)
    return numbered.withColumn("_block", F.coalesce(F.shiftright("_no", BLOCK_BITS), F.lit(-1)))


def _order() -> Column:
    """Shifts in the order of their numbers, then of their ids."""
    return F.struct("_no", "timesheet_id")


def _not_null(*names: str) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in names])


# --- consecutive days ------------------------------------------------------


def streak_days(days: DataFrame) -> DataFrame:
    """Each worked day with its streak: the id shared by the streak's days and its length.

    Within a run of consecutive days, day minus rank is the same date. A day may occur several times.
    """
    by_staff = Window.partitionBy("staff_id").orderBy("shift_date")
    by_streak = Window.partitionBy("staff_id", "streak")
    length = F.max("_rank").over(by_streak) - F.min("_rank").over(by_streak) + 1
    return (
        days.withColumn("_rank", F.dense_rank().over(by_staff))
        .withColumn("streak", F.date_sub("shift_date", F.col("_rank")))
        .withColumn("streak_length", length.cast("long"))
        .drop("_rank")
    )


def staff_streaks(shifts: DataFrame) -> DataFrame:
    """First day, last day and length of every streak."""
    return (
        streak_days(distinct_staff_days(shifts))
        .groupBy("staff_id", "streak")
        .agg(
            F.min("shift_date").alias("streak_start"),
            F.max("shift_date").alias("streak_end"),
            F.count("*").alias("streak_length"),
        )
        .drop("streak")
    )


def _over_limit() -> Column:
    return flag(F.col("streak_length") > rules.STREAK_LIMIT_DAYS)


def with_consecutive_days(shifts: DataFrame, day_cases: DataFrame | None = None) -> DataFrame:
    """1 for every day of a streak above the limit, its first days included.

    ``day_cases`` adds the day's case counts in the same join.
    """
    days = streak_days(distinct_staff_days(shifts))
    days = days.select(*DAY, _over_limit().alias("consecutive_days_flag"))
    if day_cases is not None:
        days = days.join(day_cases, DAY, "left")
    attached = attach(shifts, days, DAY)
    return attached.fillna(0, [name for name in days.columns if name not in DAY])


# --- the shift before ------------------------------------------------------

_IN_TIME = ["staff_id", "shift_start", "shift_end", "_no", "timesheet_id"]


def _with_shift_before(shifts: DataFrame) -> DataFrame:
    """Shifts with ``_before``, the shift before in the order of start, end and id.

    It may belong to another staff member; see ``_after``. A total order over all shifts needs no
    group per person: a person with a third of all shifts is cut into ranges as others are.
    """
    numbered = _with_block(shifts).drop("_block")
    carried = ["staff_id", "shift_start", "shift_end", "shift_duration_hours"]
    return with_row_before(numbered, _IN_TIME, carried, "_before")


def _after(name: str) -> Column:
    """A column of the shift before, if that is the same staff member's and has a start."""
    before = F.col("_before")
    same = (before["staff_id"] == F.col("staff_id")) & before["shift_start"].isNotNull()
    return F.when(same, before[name])


def _gap_hours() -> Column:
    return hours_between(_after("shift_end"), F.col("shift_start"))


def with_gap_hours(shifts: DataFrame) -> DataFrame:
    """``gap_hours`` since the end of the staff member's previous shift, null for the first.

    Writes the shifts in order to the shared folder when it is called."""
    ordered = _with_shift_before(shifts)
    return ordered.withColumn("gap_hours", _gap_hours()).drop("_no", "_before")


def _follows_long_shift() -> Column:
    """A long shift within the limit after another."""
    return (
        (F.col("shift_duration_hours") >= rules.LONG_SHIFT_HOURS)
        & (_after("shift_duration_hours") >= rules.LONG_SHIFT_HOURS)
        & _gap_hours().between(0, rules.BACK_TO_BACK_GAP_HOURS)
    )


def with_back_to_back(shifts: DataFrame) -> DataFrame:
    """1 for a long shift that follows another long one of the same staff member within the limit.

    Writes the shifts in order to the shared folder when it is called."""
    ordered = _with_shift_before(shifts)
    return ordered.withColumn("back_to_back_12h_flag", flag(_follows_long_shift())).drop(
        "_no", "_before"
    )


# --- night to day ----------------------------------------------------------


def _last_shift() -> Column:
    """The last shift in order, and whether it was at night."""
    return F.max(F.struct("_no", "timesheet_id", flag(F.col("shift_type") == "Night").alias("night")))


def _blocks(shifts: DataFrame) -> DataFrame:
    """One row per (staff, day, block) with its last shift."""
    known = _with_block(shifts).where(_not_null(*DAY))
    return known.groupBy(*DAY, "_block").agg(_last_shift().alias("_last"))


def _days(blocks: DataFrame) -> DataFrame:
    """One row per (staff, day) with the last shift of the worked day before."""
    by_staff = Window.partitionBy("staff_id").orderBy("shift_date")
    days = blocks.groupBy(*DAY).agg(F.max("_last").alias("_last"))
    return days.withColumn("_day_before", F.lag("_last").over(by_staff)).drop("_last")


def _carry(blocks: DataFrame, days: DataFrame) -> DataFrame:
    """Each block with the last shift before it on its day, and the columns of its day."""
    in_day = Window.partitionBy(*DAY).orderBy("_block")
    before = blocks.withColumn("_before", F.lag("_last").over(in_day)).drop("_last")
    return before.join(days, DAY)


def _with_night_before(shifts: DataFrame) -> DataFrame:
    """Shifts with block and, inside the block, whether the shift before was at night.

    The window comes before the join with the carry: the join then finds its rows sorted.
    """
    in_block = Window.partitionBy(*DAY, "_block").orderBy("_no", "timesheet_id")
    night_before = F.lag(flag(F.col("shift_type") == "Night")).over(in_block)
    return _with_block(shifts).withColumn("_night_before", night_before)


def _flip_flag() -> Column:
    """Day after Night, in the order of date and id; the gap does not matter."""
    night_before = F.coalesce("_night_before", F.coalesce("_before.night", "_day_before.night"))
    return flag(
        F.col("staff_id").isNotNull() & (F.col("shift_type") == "Day") & (night_before == 1)
    )


def with_night_to_day_flip(shifts: DataFrame) -> DataFrame:
    blocks = _blocks(shifts)
    carry = _carry(blocks, _days(blocks))
    joined = _with_night_before(shifts).join(carry, [*DAY, "_block"], "left")
    return joined.withColumn("night_to_day_flip_flag", _flip_flag()).drop(*_WORKING)


# --- all at once -----------------------------------------------------------


def _followers(shifts: DataFrame) -> DataFrame:
    """Narrow copies of the shifts that follow a long one, to be marked in their block."""
    columns = [*_SHIFT, "shift_duration_hours"]
    return _with_shift_before(shifts.select(*columns)).where(_follows_long_shift()).select(*_SHIFT)


def _history_by_blocks(shifts: DataFrame, day_cases: DataFrame) -> DataFrame:
    """All history flags and the day's case counts, for people with any number of shifts.

    Everything is brought to the grain of blocks first. The full shifts are then shuffled to
    (staff, day, block) once, which serves both the window and the join. A shift that follows a long
    one is sent along a second time, in narrow form, and sorted right behind itself: the window then
    sees that a mark comes next. Narrow columns of the shifts in order go to the shared folder when
    this is called.
    """
    blocks = _blocks(shifts)
    days = streak_days(_days(blocks)).withColumn("consecutive_days_flag", _over_limit())
    days = days.drop("streak", "streak_length").join(day_cases, DAY, "left")
    marks = _with_block(_followers(shifts)).withColumn("_mark", F.lit(True))
    marked = _with_block(shifts).withColumn("_mark", F.lit(False))
    marked = marked.unionByName(marks, allowMissingColumns=True)
    in_block = Window.partitionBy(*DAY, "_block").orderBy(
        "_no", "timesheet_id", "shift_start", "shift_end", "_mark"
    )
    seen = marked.withColumns(
        {
            # a mark has the type of its shift
            "_night_before": F.lag(flag(F.col("shift_type") == "Night")).over(in_block),
            "back_to_back_12h_flag": flag(F.lead("_mark").over(in_block)),
        }
    ).where(~F.col("_mark"))
    joined = seen.join(_carry(blocks, days), [*DAY, "_block"], "left")
    flagged = joined.withColumn("night_to_day_flip_flag", _flip_flag())
    counts = ["consecutive_days_flag", "critical_cases", "emergency_cases"]
    return flagged.fillna(0, counts).drop(*_WORKING)


def _history_by_person(shifts: DataFrame, day_cases: DataFrame) -> DataFrame:
    """The same for people with at most 2^16 shifts each, moving the full shifts only once.

    The shifts are shuffled by person, and the day's cases along with them as rows of their own: a
    join by person and day would move the shifts again. All windows find their rows there.
    """
    rows = _with_block(shifts).drop("_block").withColumn("_mark", F.lit(False))
    cases = day_cases.withColumn("_mark", F.lit(True))
    # rows of cases, alike but for the day, are put in its order too: the next sort finds long runs
    in_time = Window.partitionBy("staff_id").orderBy(*_IN_TIME[1:], "shift_date")
    # the cases of a day come before its shifts
    in_days = Window.partitionBy("staff_id").orderBy(
        "shift_date", F.desc("_mark"), "_no", "timesheet_id"
    )
    earlier = in_days.rowsBetween(Window.unboundedPreceding, -1)
    carried = F.struct("staff_id", "shift_start", "shift_end", "shift_duration_hours")
    known = _not_null(*DAY)
    counts = ["critical_cases", "emergency_cases"]
    # null for rows that are no shift or have no place in the order
    at_night = F.when(known & ~F.col("_mark"), flag(F.col("shift_type") == "Night"))
    day_cases_row = F.when(F.col("_mark"), F.struct("shift_date", *counts))
    of_day = known & (F.col("_cases.shift_date") == F.col("shift_date"))
    seen = (
        rows.unionByName(cases, allowMissingColumns=True)
        .withColumn("_before", F.lag(carried).over(in_time))
        .withColumn("back_to_back_12h_flag", flag(_follows_long_shift()))
        .withColumns(
            {
                "_night_before": F.last(at_night, ignorenulls=True).over(earlier),
                "_cases": F.last(day_cases_row, ignorenulls=True).over(earlier),
            }
        )
        .where(~F.col("_mark"))
        .withColumns({name: F.when(of_day, F.col(f"_cases.{name}")) for name in counts})
        .fillna(0, counts)
    )
    flip = known & (F.col("shift_type") == "Day") & (F.col("_night_before") == 1)
    return (
        streak_days(seen.withColumn("night_to_day_flip_flag", flag(flip)))
        .withColumn("consecutive_days_flag", F.when(known, _over_limit()).otherwise(0))
        .drop("_no", "_mark", "_before", "_night_before", "_cases", "streak", "streak_length")
    )


def _crowded(shifts: DataFrame) -> Column | None:
    """Whether a shift is one of a person with more than 2^16 of them; None if there is no such
    person. Their ids come to the driver, at most one for 2^16 shifts."""
    per_person = shifts.groupBy("staff_id").agg(F.count("*").alias("_shifts"))
    crowded = per_person.where(F.col("_shifts") > (1 << BLOCK_BITS)).select("staff_id")
    people = [row.staff_id for row in crowded.collect()]
    if not people:
        return None
    person = F.col("staff_id")
    nobody = F.lit(None in people)
    return F.when(person.isNull(), nobody).otherwise(person.isin([p for p in people if p is not None]))


def with_history(shifts: DataFrame, day_cases: DataFrame) -> DataFrame:
    """All history flags and the day's case counts.

    A person's shifts are looked at together. People with more than 2^16 shifts, and shifts without a
    person if there are as many, are cut into blocks instead, so that no task holds more. The shifts
    are counted per person when this is called.
    """
    crowded = _crowded(shifts)
    if crowded is None:
        return _history_by_person(shifts, day_cases)
    few = _history_by_person(shifts.where(~crowded), day_cases)
    return few.unionByName(_history_by_blocks(shifts.where(crowded), day_cases))
