"""Data quality: counts, rates and invariants, each measured over the whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.choices import flag
from rosterlake.operators.staff import active_staff, leave_eligible_staff


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def qa_table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    return _union(
        [
            table.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(table.columns)).cast("long").alias("column_count"),
                F.lit(", ".join(table.columns)).alias("column_names"),
            )
            for name, table in tables.items()
        ]
    )


def _percentage(part: Column, whole: Column) -> Column:
    return F.bround(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), 2)


def qa_home_shift_mismatch(shifts: DataFrame) -> DataFrame:
    """Shifts worked outside the home department."""
    elsewhere = ~F.col("department_override").eqNullSafe(F.col("home_department"))
    return shifts.agg(
        F.count("*").alias("shift_count"), F.coalesce(F.sum(flag(elsewhere)), F.lit(0)).alias("mismatches")
    ).withColumn("mismatch_pct", _percentage(F.col("mismatches"), F.col("shift_count")))


def qa_shift_assignment_mismatch(assignments: DataFrame, shifts: DataFrame) -> DataFrame:
    """Assignments in a department where the staff member had no shift that day.

    Both sides are reduced to (staff, day, department) before they meet.
    """
    key = ["staff_id", "assignment_date", "department"]
    counts = assignments.groupBy(*key).agg(F.count("*").alias("_rows"))
    worked = (
        shifts.select(
            "staff_id",
            F.col("shift_date").alias("assignment_date"),
            F.col("department_override").alias("department"),
        )
        .distinct()
        .withColumn("_worked", F.lit(True))
    )
    return (
        counts.join(worked, key, "left")
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("assignment_count"),
            F.coalesce(F.sum(F.when(F.col("_worked").isNull(), F.col("_rows"))), F.lit(0)).alias(
                "mismatches"
            ),
        )
        .withColumn("mismatch_pct", _percentage(F.col("mismatches"), F.col("assignment_count")))
    )


def _check(name: str, violations: DataFrame) -> DataFrame:
    """One row: the check's name and the value of the one column of ``violations``."""
    return violations.toDF("violations").select(
        F.lit(name).alias("check_name"), F.coalesce("violations", F.lit(0)).alias("violations")
    )


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*"))


def _missing(df: DataFrame) -> DataFrame:
    """1 if the table is empty, else 0."""
    return df.agg(flag(F.count("*") == 0))


def _rows_per_staff(rows: DataFrame) -> DataFrame:
    return rows.groupBy("staff_id").agg(F.count("*").alias("_rows"))


def qa_argument_checks(
    staff: DataFrame, shifts: DataFrame, leaves: DataFrame, assignments: DataFrame
) -> DataFrame:
    """What must hold of the inputs; every count of violations should be 0.

    Rows are counted per staff id before they meet the staff table.
    """

    def orphans(rows: DataFrame) -> DataFrame:
        return _rows_per_staff(rows).join(staff, "staff_id", "left_anti").agg(F.sum("_rows"))

    unknown_role = ~F.col("role").isin(list(rules.BASE_HOURLY_RATE)) | F.col("role").isNull()
    per_shift = assignments.groupBy("timesheet_id").agg(F.count("*").alias("_rows"))
    unlike = shifts.select("timesheet_id", "assignment_count").join(per_shift, "timesheet_id", "full")
    unequal = ~F.coalesce("_rows", F.lit(0)).eqNullSafe(
        F.coalesce(F.greatest("assignment_count", F.lit(0)), F.lit(0))
    )
    return _union(
        [
            _check("no_active_staff", _missing(active_staff(staff))),
            _check("no_leave_eligible_staff", _missing(leave_eligible_staff(staff))),
            _check("shift_of_unknown_staff", orphans(shifts)),
            _check("leave_of_unknown_staff", orphans(leaves)),
            _check("assignment_of_unknown_staff", orphans(assignments)),
            _check("staff_of_unknown_role", _count(staff.where(unknown_role))),
            _check("assignment_count_unequal", _count(unlike.where(unequal))),
        ]
    )


def qa_inactive_with_shifts(staff: DataFrame, shifts: DataFrame, leaves: DataFrame) -> DataFrame:
    """Shifts of staff who are not Active and leaves of Inactive staff, per status."""
    people = staff.select("staff_id", F.coalesce("status", F.lit("")).alias("status"))

    def per_status(rows: DataFrame, name: str) -> DataFrame:
        joined = people.join(_rows_per_staff(rows), "staff_id", "left")
        return joined.groupBy("status").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias(name))

    counts = per_status(shifts, "shift_count").join(per_status(leaves, "leave_count"), "status")
    broken = F.when(F.col("status") != "Active", F.col("shift_count")).otherwise(F.lit(0)) + F.when(
        F.col("status") == "Inactive", F.col("leave_count")
    ).otherwise(F.lit(0))
    return counts.withColumn("violations", broken)


def require_active(staff: DataFrame) -> None:
    """Stop a run that has nobody to schedule."""
    if active_staff(staff).isEmpty():
        raise ValueError("no Active staff: there are no shifts to derive")


def require_leave_eligible(staff: DataFrame) -> None:
    """Stop a run that has nobody to grant leave to."""
    if leave_eligible_staff(staff).isEmpty():
        raise ValueError("no leave-eligible staff: there are no leaves to derive")


def require_clean(checks: DataFrame) -> None:
    """Stop the run if a check of ``qa_argument_checks`` was violated."""
    broken = [row.check_name for row in checks.where("violations > 0").collect()]
    if broken:
        raise ValueError(f"input checks failed: {', '.join(sorted(broken))}")
