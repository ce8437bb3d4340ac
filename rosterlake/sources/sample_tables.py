"""The base tables of this library, derived from the given sales tables.

suppliers stand for staff, order lines for shifts, orders for leaves. FIXTURES.md lists the
rules. Ids are the sales tables' numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.choices import flag
from rosterlake.functions.ids import format_id
from rosterlake.functions.pay import hourly_rate, salary_band
from rosterlake.operators.assignments import expand_assignments, with_surge_emergency_flag
from rosterlake.operators.cleaning import dedup_by_key
from rosterlake.operators.joins import keep_matching
from rosterlake.operators.staff import join_employment_type, leave_eligible_staff
from rosterlake.sources.tables import read_table

# A parameter of the leave queries, as of the rule: no leave is looked at beyond this day.
WINDOW_END = date(2001, 8, 1)

LINE_KEY = ["l_orderkey", "l_linenumber"]
EMPLOYMENT_BASES = ["permanent", "temporary", "hourly"]
SHIFT_PREFERENCES = ["early", "late", "none"]
ROUTINE_CASES = rules.CASE_TYPES[1:]
APPROVALS = {"F": "Approved", "O": "Pending", "P": "Rejected"}


def line_order() -> list[str | Column]:
    """Which of several lines with the same key survives: a total order."""
    return [
        F.desc("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ]


def sales_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder.rstrip('/')}/{name}.parquet")


def _one_of(values: Sequence[str], place: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), place.cast("int"))


def staff_master(spark: SparkSession, folder: str) -> DataFrame:
    supplier = sales_table(spark, folder, "supplier")
    key = F.col("s_suppkey")
    return (
        supplier.select(
            key.alias("staff_id"),
            F.col("s_name").alias("staff_name"),
            F.when(key % 9 < 5, "Female").otherwise("Male").alias("gender"),
            _one_of(rules.ROLES, key % 8).alias("role"),
            _one_of(rules.EXPERIENCE_LEVELS, key % 3).alias("experience_level"),
            _one_of(rules.DEPARTMENTS, F.col("s_nationkey") % 8).alias("department"),
            F.date_add(F.lit(date(2015, 1, 1)), (key * 37 % 3650).cast("int")).alias("hire_date"),
            _one_of(EMPLOYMENT_BASES, key % 3).alias("_base"),
            _one_of(SHIFT_PREFERENCES, key % 3).alias("shift_preference"),
            F.when(key % 20 == 19, "Inactive")
            .when(key % 20 == 9, "On Leave")
            .otherwise("Active")
            .alias("status"),
            F.concat(F.lit("site "), F.col("s_nationkey")).alias("base_location"),
        )
        .withColumn("employment_type", join_employment_type(F.col("_base"), F.col("gender")))
        .withColumn(
            "per_hour_rate",
            (
                hourly_rate(F.col("role"), F.col("experience_level"))
                + (F.col("staff_id") * 37 % 100).cast("decimal(10,2)") * F.lit("0.01").cast("decimal(3,2)")
            ).cast("double"),
        )
        .withColumn("salary_band", salary_band(F.col("per_hour_rate")))
        .withColumn("night_shift_female_flag", F.lit(0).cast("long"))
        .drop("_base")
    )


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines; their key occurs several times."""
    return sales_table(spark, folder, "lineitem")


def with_timesheet_id(lines: DataFrame) -> DataFrame:
    return lines.withColumn("timesheet_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def raw_shifts(lines: DataFrame) -> DataFrame:
    part = F.col("l_partkey")
    return lines.select(
        "timesheet_id",
        F.col("l_suppkey").alias("staff_id"),
        F.col("l_shipdate").cast("date").alias("shift_date"),
        F.when(F.col("l_linestatus") == "F", "Night").otherwise("Day").alias("shift_type"),
        (8 + F.col("l_quantity").cast("long") % 7).alias("shift_duration_hours"),
        (20 + part % 41).alias("break_minutes"),
        (part % 20 != 0).alias("logged_hours_flag"),
        flag(part % 20 < 3).alias("cross_post_flag"),
        _one_of(rules.DEPARTMENTS, part % 8).alias("other_department"),
        (1 + F.when(part % 10 < 6, part % 3).otherwise(2 + part % 14)).alias("assignment_count"),
        part.alias("case_seed"),
    )


def shifts(spark: SparkSession, folder: str) -> DataFrame:
    """Shifts, one per id, of all staff.

    The id is one number made of the line's key. Spark compares it by its sort prefix, so
    the columns of the order count for copies only.
    """
    lines = with_timesheet_id(raw_lines(spark, folder))
    return raw_shifts(dedup_by_key(lines, ["timesheet_id"], line_order()))


def assignments(worked: DataFrame) -> DataFrame:
    """Assignments of shifts that carry ``department_override``."""
    expanded = expand_assignments(
        worked.select(
            "timesheet_id", "staff_id", "shift_date", "department_override",
            "assignment_count", "case_seed",
        )
    )
    number, seed = F.col("assignment_no"), F.col("case_seed")
    case_type = F.when((seed * 13 + number) % 5 < 2, F.lit(rules.CASE_TYPES[0])).otherwise(
        _one_of(ROUTINE_CASES, (seed + number) % 4)
    )
    assignment_id = F.col("timesheet_id") * 100 + number
    return expanded.select(
        assignment_id.alias("assignment_id"),
        "timesheet_id",
        "staff_id",
        format_id("PAT_", 100000 + assignment_id % 899999).alias("patient_id"),
        "assignment_date",
        (1 + (seed + number) % 5).alias("severity_level"),
        "department",
        case_type.alias("case_type"),
        (15 + (seed + number * 7) % 166).alias("assignment_duration_minutes"),
        flag((seed * 7 + number * 3) % 10 < 4).alias("critical_flag"),
    ).transform(with_surge_emergency_flag)


def raw_assignments(spark: SparkSession, folder: str) -> DataFrame:
    """Assignments as delivered: for every order line, copies of a shift included, and in the
    department of the part, which need not be the shift's."""
    delivered = raw_shifts(with_timesheet_id(raw_lines(spark, folder)))
    return expand_assignments(
        delivered.select(
            "timesheet_id",
            "staff_id",
            "shift_date",
            F.col("other_department").alias("department_override"),
            "assignment_count",
        )
    )


def raw_leave_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves as delivered, also of staff who are unknown or not eligible."""
    orders = sales_table(spark, folder, "orders")
    people = sales_table(spark, folder, "supplier").count()
    return orders.select(
        F.col("o_orderkey").alias("leave_id"),
        (F.col("o_custkey") % people).alias("staff_id"),
        F.col("o_orderdate").cast("date").alias("leave_start"),
        (1 + F.col("o_orderkey") % 14).alias("duration_days"),
        _one_of(rules.LEAVE_TYPES, F.col("o_custkey") % 6).alias("leave_type"),
        _approval(F.col("o_orderstatus")).alias("approval_status"),
        (F.col("o_orderpriority") == "1-URGENT").alias("emergency_leave_flag"),
    )


def leave_requests(spark: SparkSession, folder: str, staff: DataFrame) -> DataFrame:
    """Leaves of eligible staff as requested: start and duration, not yet moved."""
    requested = raw_leave_requests(spark, folder)
    return keep_matching(requested, leave_eligible_staff(staff), ["staff_id"])


def _approval(status: Column) -> Column:
    found = F.lit(None).cast("string")
    for code, name in APPROVALS.items():
        found = F.when(status == code, F.lit(name)).otherwise(found)
    return found
