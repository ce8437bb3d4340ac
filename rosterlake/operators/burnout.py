"""Burnout score, risk label and chronic uplift on shifts with history columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import scoring


def with_burnout_components(shifts: DataFrame) -> DataFrame:
    """The weighted terms of the acute score as columns ``score_<driver>``."""
    terms = {f"score_{name}": term.cast("double") for name, term in scoring.score_terms().items()}
    return shifts.withColumns(terms)


def with_acute_score(shifts: DataFrame) -> DataFrame:
    return shifts.withColumn("acute_score", scoring.acute_score())


def with_risk_label(shifts: DataFrame, score: str = "burnout_score") -> DataFrame:
    return shifts.withColumn("burnout_risk_label", scoring.risk_label(F.col(score)))


def with_susceptibility(shifts: DataFrame) -> DataFrame:
    hundredths = scoring.susceptibility_hundredths(
        F.col("role"), F.col("home_department"), F.col("experience_level")
    )
    return shifts.withColumn("susceptibility", hundredths / F.lit(100.0))


def with_acute_load(shifts: DataFrame) -> DataFrame:
    return shifts.withColumn(
        "acute_load", scoring.acute_load_ten_thousandths() / F.lit(10_000.0)
    )


def _chronic_millionths() -> Column:
    return scoring.chronic_millionths(
        scoring.susceptibility_hundredths(
            F.col("role"), F.col("home_department"), F.col("experience_level")
        ),
        scoring.acute_load_ten_thousandths(),
    )


def with_chronic_probability(shifts: DataFrame) -> DataFrame:
    return shifts.withColumn("chronic_prob", _chronic_millionths() / F.lit(1_000_000.0))


def with_chronic_uplift(shifts: DataFrame) -> DataFrame:
    """Final score and label: the acute score plus the uplift that was drawn."""
    boost = scoring.chronic_boost(F.col("timesheet_id"), _chronic_millionths())
    final = scoring.clip_score(F.col("acute_score") + F.col("chronic_boost"))
    return (
        shifts.withColumn("chronic_boost", boost)
        .withColumn("burnout_score", final)
        .transform(with_risk_label)
    )


def with_burnout(shifts: DataFrame) -> DataFrame:
    return shifts.transform(with_acute_score).transform(with_chronic_uplift)
