"""Rates, salary bands and overtime pay. Money is computed in decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.choices import decimal_lit, first_limit, lookup


def hourly_rate(role: Column, experience: Column, noise: Column | None = None) -> Column:
    """Base rate of the role x multiplier of the experience x noise, rounded once to 2 decimals.

    An unknown role gives null and is counted by the argument checks; an unknown
    experience counts as 1.0.
    """
    base = lookup(role, rules.BASE_HOURLY_RATE)
    multiplier = lookup(
        experience, rules.EXPERIENCE_MULTIPLIER, decimal_lit(rules.UNKNOWN_EXPERIENCE_MULTIPLIER)
    )
    noise = decimal_lit("1.0") if noise is None else noise.cast("decimal(18,12)")
    return F.bround(base * multiplier * noise, 2).cast("decimal(10,2)")


def salary_band(rate: Column) -> Column:
    annual = rate.cast("decimal(10,2)") * rules.WORK_HOURS_PER_YEAR
    limits = [(limit, F.lit(band)) for band, limit in rules.SALARY_BANDS.items()]
    return first_limit(annual, limits, F.lit(rules.TOP_SALARY_BAND), included=False)


def overtime_hours(duration: Column) -> Column:
    """Hours beyond the standard shift, never negative, to 2 decimals."""
    extra = duration.cast("double") - F.lit(float(rules.STANDARD_SHIFT_HOURS))
    return F.bround(F.greatest(F.lit(0.0), extra), 2)


def overtime_multiplier(overtime: Column) -> Column:
    """One rate for all overtime hours of the shift: the tier of the total."""
    limits = [(float(limit), F.lit(float(rate))) for limit, rate in rules.OVERTIME_TIERS.items()]
    return first_limit(
        overtime, limits, F.lit(float(rules.TOP_OVERTIME_MULTIPLIER)), included=True
    )


def overtime_pay(overtime: Column, rate: Column) -> Column:
    """Overtime hours x hourly rate x multiplier, half-even to 2 decimals.

    The factors are whole numbers of hundredths, cents and tenths, so the product is exact
    and ties are true ties.
    """
    cents = F.round(F.coalesce(rate, F.lit(float(rules.DEFAULT_HOURLY_RATE))) * 100).cast("long")
    hundredths = F.round(overtime * 100).cast("long")
    tenths = F.round(overtime_multiplier(overtime) * 10).cast("long")
    return F.bround(cents * hundredths * tenths, -3) / F.lit(100_000.0)
