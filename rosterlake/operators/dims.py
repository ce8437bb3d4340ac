"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.calendar import surge_flag
from rosterlake.functions.choices import flag, lookup
from rosterlake.functions.ids import format_id

STAFF_COLUMNS = [
    "staff_id", "staff_name", "gender", "role", "experience_level", "department", "hire_date",
    "employment_type", "shift_preference", "status", "base_location", "per_hour_rate",
    "salary_band", "night_shift_female_flag",
]


def dim_date(bounds: DataFrame, years=None) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of the one-row table ``bounds``."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    day = F.col("full_date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("long").alias("date_key"),
        day,
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.weekday(day).alias("day_num"),
        F.weekofyear(day).cast("long").alias("week_number"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        flag(F.weekday(day) >= 5).alias("is_weekend"),
        surge_flag(day, years).alias("is_surge_period"),
    )


def calendar_bounds(spark: SparkSession, first_day, last_day) -> DataFrame:
    return spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"),
        F.lit(last_day).cast("date").alias("last_day"),
    )


def risk_category(department: Column) -> Column:
    return lookup(department, rules.RISK_CATEGORY, to=F.lit)


def dim_department(spark: SparkSession) -> DataFrame:
    departments = spark.createDataFrame(
        list(enumerate(rules.DEPARTMENTS, 1)), "number int, department_name string"
    )
    category = risk_category(F.col("department_name"))
    return departments.select(
        format_id("DEPT_", F.col("number")).alias("dept_id"),
        "department_name",
        category.alias("risk_category"),
        flag(category.isin(rules.CRITICAL_CATEGORIES)).alias("is_critical_dept"),
    )


def dim_shift_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        rules.SHIFT_TYPES,
        "shift_type_id long, shift_type_name string, shift_start_hr long, "
        "burnout_weight double, description string",
    )


def with_fact_count(
    dimension: DataFrame, name: str, facts: DataFrame, column: str, count: str
) -> DataFrame:
    """All rows of a dimension, with the facts of each counted; 0 where there is none."""
    counts = facts.groupBy(F.col(column).alias(name)).agg(F.count("*").alias(count))
    return dimension.join(counts, name, "left").fillna(0, [count])


def dim_staff(staff: DataFrame) -> DataFrame:
    return staff.select(*STAFF_COLUMNS)
