"""Staff master: derived columns, filters and lookups onto shifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.choices import flag
from rosterlake.functions.pay import hourly_rate, salary_band
from rosterlake.operators.joins import attach

LOOKUP_COLUMNS = {
    "gender": "gender",
    "department": "home_department",
    "status": "staff_status",
    "per_hour_rate": "per_hour_rate",
    "role": "role",
    "experience_level": "experience_level",
}


def with_hourly_rate(staff: DataFrame, noise: Column | None = None) -> DataFrame:
    rate = hourly_rate(F.col("role"), F.col("experience_level"), noise)
    return staff.withColumn("per_hour_rate", rate.cast("double"))


def with_salary_band(staff: DataFrame) -> DataFrame:
    return staff.withColumn("salary_band", salary_band(F.col("per_hour_rate")))


def join_employment_type(base: Column, gender: Column) -> Column:
    return F.concat_ws("/", base, gender)


def split_employment_type(staff: DataFrame) -> DataFrame:
    """Take the composite apart again: ``employment_base`` and ``employment_gender``."""
    parts = F.split("employment_type", "/")
    return staff.withColumns(
        {"employment_base": F.get(parts, F.lit(0)), "employment_gender": F.get(parts, F.lit(1))}
    )


def active_staff(staff: DataFrame) -> DataFrame:
    return staff.where(F.col("status") == "Active")


def leave_eligible_staff(staff: DataFrame) -> DataFrame:
    """All but Inactive staff; a missing status is eligible."""
    return staff.where(~F.col("status").eqNullSafe("Inactive"))


def with_staff_attributes(shifts: DataFrame, staff: DataFrame) -> DataFrame:
    """Staff columns on each shift; an unknown staff member has gender '' and no rate."""
    attributes = staff.select(
        "staff_id", *[F.col(source).alias(name) for source, name in LOOKUP_COLUMNS.items()]
    )
    joined = attach(shifts, attributes, ["staff_id"])
    return joined.withColumn("gender", F.coalesce("gender", F.lit("")))


def backfill_female_night(staff: DataFrame, shifts: DataFrame) -> DataFrame:
    """Set ``night_shift_female_flag`` from the shifts: 1 if any of them is a female night.

    The flagged ids are made distinct before the join, so both sides have one row per id.
    Write the result to a new place: Spark cannot overwrite what it is reading.
    """
    worked_nights = (
        shifts.where("female_night_flag = 1")
        .select("staff_id")
        .distinct()
        .withColumn("_worked", F.lit(True))
    )
    return (
        staff.join(worked_nights, "staff_id", "left")
        .withColumn("night_shift_female_flag", flag(F.col("_worked")))
        .drop("_worked")
    )
