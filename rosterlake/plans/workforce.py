"""From base tables to the enriched timesheet, leave records, dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.operators.assignments import day_case_counts
from rosterlake.operators.burnout import with_burnout
from rosterlake.operators.cleaning import silver_stamp
from rosterlake.operators.dims import calendar_bounds, dim_date, dim_department, dim_shift_type
from rosterlake.operators.dims import dim_staff
from rosterlake.operators.facts import fact_burnout, fact_leave, fact_overtime
from rosterlake.operators.history import with_history
from rosterlake.operators.joins import keep_matching
from rosterlake.operators.leave import resolve_leave_conflicts, with_leave_days, worked_days
from rosterlake.operators.quality import require_active, require_leave_eligible
from rosterlake.operators.shifts import with_shift_columns
from rosterlake.operators.staff import (
    backfill_female_night,
    leave_eligible_staff,
    with_staff_attributes,
)
from rosterlake.session import LakeLayout
from rosterlake.sources.tables import read_silver, write_silver

TIMESHEET_COLUMNS = [
    "timesheet_id", "staff_id", "shift_date", "shift_start", "shift_end", "shift_type",
    "shift_duration_hours", "overtime_hours", "break_minutes", "department_override",
    "logged_hours_flag", "burnout_score", "burnout_risk_label", "surge_period_flag",
    "consecutive_days_flag", "back_to_back_12h_flag", "night_to_day_flip_flag",
    "female_night_flag", "overtime_multiplier", "overtime_pay",
]
LEAVE_COLUMNS = [
    "leave_id", "staff_id", "leave_start", "leave_end", "leave_type", "leave_days_count",
    "approval_status", "emergency_leave_flag",
]


def active_shifts(
    shifts: DataFrame, staff: DataFrame, years: Sequence[int] | None = None
) -> DataFrame:
    """Shifts of Active staff with the staff lookup and all columns of the shift itself."""
    looked_up = with_staff_attributes(shifts, staff).where(F.col("staff_status") == "Active")
    return with_shift_columns(looked_up, years)


def scored_shifts(shifts: DataFrame, assignments: DataFrame) -> DataFrame:
    """Shifts with history, case counts, score and label; keeps all working columns."""
    return with_history(shifts, day_case_counts(assignments)).transform(with_burnout)


def timesheet_enriched(shifts: DataFrame, assignments: DataFrame) -> DataFrame:
    return scored_shifts(shifts, assignments).select(*TIMESHEET_COLUMNS)


def leave_records(requests: DataFrame, shifts: DataFrame, window_end: date) -> DataFrame:
    """Leave moved clear of worked days, as far as the rule goes."""
    worked = worked_days(shifts, requests)
    return (
        resolve_leave_conflicts(requests, worked, window_end)
        .transform(with_leave_days)
        .select(*LEAVE_COLUMNS)
    )


def build_silver(
    spark: SparkSession,
    layout: LakeLayout,
    staff: DataFrame,
    shifts: DataFrame,
    assignments: Callable[[DataFrame], DataFrame],
    requests: DataFrame,
    window_end: date,
) -> list[str]:
    """Plain base tables -> the four silver tables; returns their names.

    ``shifts``: one row per shift with staff, day, type and hours, of any staff. ``assignments``
    makes the patient assignments of the Active staff's shifts. ``requests``: leave as asked for.
    The order is that of the tables' needs: staff first, then shifts and their assignments, then
    leave, which gives way to worked days, and at last the flag that goes back to the staff. The
    run stops before it writes anything if there is nobody to schedule or to grant leave to. Each
    table is read back from silver where the next one needs it.
    """
    require_active(staff)
    require_leave_eligible(staff)
    working = active_shifts(shifts, staff)
    assigned = assignments(working)

    def put(name: str, df: DataFrame) -> DataFrame:
        write_silver(silver_stamp(df), layout.silver(name), layout.table_format)
        return read_silver(spark, layout.silver(name), layout.table_format)

    put("patient_assignment", assigned.drop("timesheet_id"))
    timesheet = put("staff_timesheet", timesheet_enriched(working, assigned))
    eligible = keep_matching(requests, leave_eligible_staff(staff), ["staff_id"])
    put("leave_records", leave_records(eligible, timesheet, window_end))
    put("staff_master", backfill_female_night(staff, timesheet))
    return ["patient_assignment", "staff_timesheet", "leave_records", "staff_master"]


def build_gold(
    spark: SparkSession,
    layout: LakeLayout,
    first_day: date,
    last_day: date,
) -> list[str]:
    """Silver tables -> dimensions and facts in the gold layer; returns the table names.

    The silver timesheet holds the enriched columns, so each fact is one pass over it.
    """
    silver = {
        name: read_silver(spark, layout.silver(name), layout.table_format).drop("silver_processed_at")
        for name in ("staff_master", "staff_timesheet", "leave_records")
    }
    staff, timesheet = silver["staff_master"], silver["staff_timesheet"]
    require_active(staff)
    require_leave_eligible(staff)
    gold = {
        "dim_date": dim_date(calendar_bounds(spark, first_day, last_day)),
        "dim_department": dim_department(spark),
        "dim_shift_type": dim_shift_type(spark),
        "dim_staff": dim_staff(backfill_female_night(staff, timesheet)),
        "fact_burnout": fact_burnout(timesheet, staff),
        "fact_overtime": fact_overtime(timesheet),
        "fact_leave": fact_leave(silver["leave_records"]),
    }
    for name, df in gold.items():
        write_silver(df, layout.gold(name), layout.table_format)
    return list(gold)
