"""Columns of a shift that follow from the shift itself and from its staff member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.calendar import shift_end, shift_start, surge_flag
from rosterlake.functions.choices import flag
from rosterlake.functions.pay import overtime_hours, overtime_multiplier, overtime_pay


def surge_windows(years: DataFrame) -> DataFrame:
    """The surge periods of each year in column ``year``: surge_start and surge_end."""
    periods = F.array(
        *[
            F.struct(
                F.lit(first[0]).alias("first_month"),
                F.lit(first[1]).alias("first_day"),
                F.lit(last[0]).alias("last_month"),
                F.lit(last[1]).alias("last_day"),
            )
            for first, last in rules.SURGE_PERIODS
        ]
    )
    return years.select("year", F.explode(periods).alias("p")).select(
        F.make_date("year", "p.first_month", "p.first_day").alias("surge_start"),
        F.make_date("year", "p.last_month", "p.last_day").alias("surge_end"),
    )


def with_shift_interval(shifts: DataFrame) -> DataFrame:
    started = shifts.withColumn("shift_start", shift_start(F.col("shift_date"), F.col("shift_type")))
    return started.withColumn(
        "shift_end", shift_end(F.col("shift_start"), F.col("shift_duration_hours"))
    )


def with_overtime(shifts: DataFrame) -> DataFrame:
    return shifts.withColumn("overtime_hours", overtime_hours(F.col("shift_duration_hours")))


def with_surge_flag(shifts: DataFrame, years=None) -> DataFrame:
    return shifts.withColumn("surge_period_flag", surge_flag(F.col("shift_date"), years))


def with_night_flag(shifts: DataFrame) -> DataFrame:
    return shifts.withColumn("night_flag", flag(F.col("shift_type") == "Night"))


def with_female_night_flag(shifts: DataFrame) -> DataFrame:
    """Needs ``gender`` from the staff lookup."""
    both = (F.col("gender") == "Female") & (F.col("shift_type") == "Night")
    return shifts.withColumn("female_night_flag", flag(both))


def with_department(shifts: DataFrame) -> DataFrame:
    """The department worked in: the other one if cross-posted, else home."""
    posted = F.when(F.col("cross_post_flag") == 1, F.col("other_department"))
    return shifts.withColumn("department_override", posted.otherwise(F.col("home_department")))


def with_overtime_pay(shifts: DataFrame) -> DataFrame:
    """Needs ``overtime_hours`` and, from the staff lookup, ``per_hour_rate``."""
    return shifts.withColumns(
        {
            "overtime_multiplier": overtime_multiplier(F.col("overtime_hours")),
            "overtime_pay": overtime_pay(F.col("overtime_hours"), F.col("per_hour_rate")),
        }
    )


def with_shift_columns(shifts: DataFrame, years=None) -> DataFrame:
    """All of the above on shifts that carry the staff lookup."""
    return (
        shifts.transform(with_shift_interval)
        .transform(with_overtime)
        .transform(with_surge_flag, years)
        .transform(with_night_flag)
        .transform(with_female_night_flag)
        .transform(with_department)
        .transform(with_overtime_pay)
    )


def qa_shift_duration_rule(shifts: DataFrame) -> DataFrame:
    """Shifts per surge flag, and those whose length is outside the rule."""
    length = F.col("shift_duration_hours")
    expected = F.when(
        F.col("surge_period_flag") == 1, length.between(*rules.SURGE_SHIFT_HOURS)
    ).otherwise(length.between(*rules.NORMAL_SHIFT_HOURS))
    return shifts.groupBy("surge_period_flag").agg(
        F.count("*").alias("shift_count"), F.sum(flag(~expected)).alias("violations")
    )
