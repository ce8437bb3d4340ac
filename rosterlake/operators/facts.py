"""Fact tables on the enriched timesheet and the leave records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.calendar import iso_year_week
from rosterlake.functions.choices import flag
from rosterlake.functions.ids import id_number
from rosterlake.functions.scoring import risk_of_rank, risk_rank
from rosterlake.operators.cleaning import dedup_staff_attrs
from rosterlake.operators.numbering import with_surrogate_key

STAFF_WEEK = ["staff_id", "year_week"]
OVERTIME_COLUMNS = [
    "timesheet_id", "staff_id", "shift_date", "shift_type", "overtime_hours",
    "shift_duration_hours", "burnout_score", "burnout_risk_label", "surge_period_flag",
    "consecutive_days_flag", "back_to_back_12h_flag", "night_to_day_flip_flag",
    "female_night_flag",
]


def with_year_week(shifts: DataFrame) -> DataFrame:
    return shifts.withColumn("year_week", iso_year_week(F.col("shift_date")))


def _staff_weeks(shifts: DataFrame) -> DataFrame:
    return shifts.transform(with_year_week).dropna(subset=STAFF_WEEK)


def worst_risk(shifts: DataFrame) -> DataFrame:
    """The highest risk label per staff member and ISO week; null if no label is known."""
    return (
        _staff_weeks(shifts)
        .groupBy(*STAFF_WEEK)
        .agg(F.max(risk_rank(F.col("burnout_risk_label"))).alias("_rank"))
        .select(*STAFF_WEEK, risk_of_rank(F.col("_rank")).alias("worst_burnout_risk"))
    )


def weekly_burnout(shifts: DataFrame) -> DataFrame:
    """The weekly measures. All are sums, counts and maxima of numbers, which Spark reduces
    in each task before the shuffle, so a staff member with many shifts is no hot spot."""

    def total(column):
        return F.sum(column).cast("long")

    return (
        _staff_weeks(shifts)
        .groupBy(*STAFF_WEEK)
        .agg(
            # whole hundredths add up to the same total in any order
            (total(F.round(F.col("overtime_hours") * 100).cast("long")) / F.lit(100.0)).alias(
                "total_overtime_hours"
            ),
            F.bround(F.avg("burnout_score"), 2).alias("avg_burnout_score"),
            F.max("burnout_score").alias("max_burnout_score"),
            total(flag(F.col("shift_type") == "Night")).alias("night_shifts_count"),
            total("surge_period_flag").alias("surge_shifts_count"),
            total(flag(F.col("burnout_score") >= rules.HIGH_BURNOUT_SCORE)).alias(
                "high_burnout_days"
            ),
            F.max("consecutive_days_flag").alias("consecutive_days_flag"),
            total("back_to_back_12h_flag").alias("back_to_back_12h_count"),
            total("night_to_day_flip_flag").alias("night_to_day_flips"),
            total("female_night_flag").alias("female_night_shifts"),
            total("shift_duration_hours").alias("total_shift_hours"),
            F.count("timesheet_id").alias("shift_count"),
            F.max(risk_rank(F.col("burnout_risk_label"))).alias("_rank"),
        )
        .withColumn("worst_burnout_risk", risk_of_rank(F.col("_rank")))
        .drop("_rank")
    )


def fact_burnout(shifts: DataFrame, staff: DataFrame) -> DataFrame:
    """Grain staff x ISO week, numbered in that order, with the staff attributes."""
    # staff columns settle which row stands for a staff member with several
    attributes = dedup_staff_attrs(staff, ["role", "salary_band", "gender", "department"])
    joined = weekly_burnout(shifts).join(attributes, "staff_id", "left")
    return with_surrogate_key(
        joined.withColumn("_staff_no", id_number(joined, "staff_id")),
        "burnout_fact_id",
        "BF_",
        order=["_staff_no", *STAFF_WEEK],
    ).drop("_staff_no")


def fact_overtime(shifts: DataFrame) -> DataFrame:
    """The shifts with overtime, numbered in the order of their ids."""
    rows = shifts.where("overtime_hours > 0").select(*OVERTIME_COLUMNS)
    return with_surrogate_key(
        rows.withColumn("_shift_no", id_number(rows, "timesheet_id")),
        "overtime_fact_id",
        "OT_",
        order=["_shift_no", "timesheet_id"],
    ).drop("_shift_no")


def fact_leave(leaves: DataFrame) -> DataFrame:
    """The leave records with a flag for emergency or long leave, numbered by leave id."""
    pressing = F.col("emergency_leave_flag") | (
        F.col("leave_days_count") >= rules.LONG_LEAVE_DAYS
    )
    flagged = leaves.withColumn("burnout_leave_flag", flag(pressing))
    return with_surrogate_key(
        flagged.withColumn("_leave_no", id_number(leaves, "leave_id")),
        "leave_fact_id",
        "LF_",
        order=["_leave_no", "leave_id"],
    ).drop("_leave_no")
