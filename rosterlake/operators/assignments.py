"""Patient assignments: expansion from shifts, case counts and case mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.calendar import surge_flag
from rosterlake.functions.choices import flag
from rosterlake.operators.history import DAY
from rosterlake.operators.joins import attach


def expand_assignments(shifts: DataFrame, count_column: str = "assignment_count") -> DataFrame:
    """One row per assignment of a shift, numbered 1..n in ``assignment_no``.

    The shift's columns are carried along; the shift's department becomes the assignment's.
    Shifts with a count below 1 or without one have no assignment.
    """
    count = F.col(count_column).cast("int")
    return (
        shifts.where(count >= 1)
        .withColumn("assignment_no", F.explode(F.sequence(F.lit(1), count)))
        .withColumnsRenamed({"shift_date": "assignment_date", "department_override": "department"})
        .drop(count_column)
    )


def with_surge_emergency_flag(assignments: DataFrame, years=None) -> DataFrame:
    in_surge = surge_flag(F.col("assignment_date"), years) == 1
    both = in_surge & (F.col("case_type") == "Emergency")
    return assignments.withColumn("surge_emergency_flag", flag(both))


def _staff_day(assignments: DataFrame) -> DataFrame:
    return assignments.withColumnRenamed("assignment_date", "shift_date").dropna(subset=DAY)


def critical_cases(assignments: DataFrame) -> DataFrame:
    cases = _staff_day(assignments).where(F.col("critical_flag") == 1)
    return cases.groupBy(*DAY).agg(F.count("*").alias("critical_cases"))


def emergency_cases(assignments: DataFrame) -> DataFrame:
    cases = _staff_day(assignments).where(F.col("case_type") == "Emergency")
    return cases.groupBy(*DAY).agg(F.count("*").alias("emergency_cases"))


def day_case_counts(assignments: DataFrame) -> DataFrame:
    """Critical and emergency cases per staff member and day, in one pass."""
    return (
        _staff_day(assignments)
        .where((F.col("critical_flag") == 1) | (F.col("case_type") == "Emergency"))
        .groupBy(*DAY)
        .agg(
            F.sum(flag(F.col("critical_flag") == 1)).alias("critical_cases"),
            F.sum(flag(F.col("case_type") == "Emergency")).alias("emergency_cases"),
        )
    )


def with_case_counts(shifts: DataFrame, day_cases: DataFrame) -> DataFrame:
    """Every shift gets the counts of its whole staff-day; 0 if there are none."""
    attached = attach(shifts, day_cases, DAY, grouped=True)
    return attached.fillna(0, ["critical_cases", "emergency_cases"])


def case_mix(assignments: DataFrame) -> DataFrame:
    """Share of each case type within its department, beside the configured share.

    The counts are small (departments x case types), so the window runs over a few rows.
    """
    counts = assignments.groupBy("department", "case_type").agg(F.count("*").alias("case_count"))
    in_department = Window.partitionBy("department")
    share = F.col("case_count") / F.sum("case_count").over(in_department)
    expected = None
    for department, shares in rules.CASE_SHARES.items():
        expected = (F.when if expected is None else expected.when)(
            F.col("department") == department, _share_of_type(shares)
        )
    return counts.withColumn("share", F.bround(share, 4)).withColumn(
        "expected_share", expected.otherwise(_share_of_type(rules.DEFAULT_CASE_SHARES))
    )


def _share_of_type(shares):
    place = F.array_position(F.array(*map(F.lit, rules.CASE_TYPES)), F.col("case_type"))
    return F.get(F.array(*[F.lit(float(share)) for share in shares]), (place - 1).cast("int"))


def assignments_per_shift(assignments: DataFrame) -> DataFrame:
    """How many shifts have 1, 2, 3 ... assignments, beside the configured shares."""
    per_shift = assignments.groupBy("timesheet_id").agg(F.count("*").alias("assignment_count"))
    spread = per_shift.groupBy("assignment_count").agg(F.count("*").alias("shift_count"))
    share = F.col("shift_count") / F.sum("shift_count").over(Window.partitionBy())
    expected = None
    for count, configured in rules.ASSIGNMENTS_PER_SHIFT.items():
        expected = (F.when if expected is None else expected.when)(
            F.col("assignment_count") == count, F.lit(float(configured))
        )
    return spread.withColumn("share", F.bround(share, 4)).withColumn(
        "expected_share", expected.otherwise(F.lit(0.0))
    )
