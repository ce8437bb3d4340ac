"""Burnout score, risk label and chronic uplift as row expressions.

The weighted sums of the uplift are sums of whole numbers, so they are exact.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake import rules
from rosterlake.functions.choices import first_limit, lookup
from rosterlake.functions.ids import draw


def _units(text: str, scale: int) -> int:
    """A configured decimal as a whole number of 10^-scale."""
    return int(Decimal(text).scaleb(scale))


def score_terms() -> dict[str, Column]:
    """The weighted terms of the acute score, one per driver."""
    return {name: F.col(name) * F.lit(weight) for name, weight in rules.SCORE_WEIGHTS.items()}


def clip_score(raw: Column) -> Column:
    """Cut to 0..100, then down to the whole number."""
    return F.least(F.greatest(raw, F.lit(0)), F.lit(rules.MAX_SCORE)).cast("long")


def acute_score() -> Column:
    return clip_score(reduce(add, score_terms().values()))


def risk_label(score: Column) -> Column:
    limits = [(limit, F.lit(label)) for label, limit in rules.RISK_LABELS.items()]
    return first_limit(score, limits, F.lit(rules.TOP_RISK_LABEL), included=True)


def risk_rank(label: Column) -> Column:
    """Low 0 ... Critical 3; null for any other label."""
    ranks = {name: rank for rank, name in enumerate(rules.RISK_ORDER)}
    return lookup(label, ranks, to=F.lit)


def risk_of_rank(rank: Column) -> Column:
    return lookup(rank, dict(enumerate(rules.RISK_ORDER)), to=F.lit)


def _weight(key: Column, weights: dict[str, str], default: str) -> Column:
    tenths = {name: _units(weight, 1) for name, weight in weights.items()}
    return lookup(key, tenths, F.lit(_units(default, 1)), to=F.lit)


def susceptibility_hundredths(role: Column, home: Column, experience: Column) -> Column:
    """How prone a person is to burnout, by role, home department and experience."""
    share = {name: _units(text, 1) for name, text in rules.SUSCEPTIBILITY_SHARES.items()}
    return (
        _weight(role, rules.ROLE_WEIGHT, rules.DEFAULT_ROLE_WEIGHT) * share["role"]
        + _weight(home, rules.DEPARTMENT_WEIGHT, rules.DEFAULT_DEPARTMENT_WEIGHT)
        * share["department"]
        + _weight(experience, rules.EXPERIENCE_WEIGHT, rules.DEFAULT_EXPERIENCE_WEIGHT)
        * share["experience"]
    ).cast("long")


def acute_load_ten_thousandths() -> Column:
    """The load of the shift: weights in hundredths times drivers in hundredths."""
    terms = [
        F.round(F.col(name) * 100).cast("long") * F.lit(_units(weight, 2))
        for name, weight in rules.LOAD_WEIGHTS.items()
    ]
    return reduce(add, terms)


def chronic_millionths(susceptible: Column, load: Column) -> Column:
    """Probability of the uplift from the two above."""
    raw = (
        F.lit(_units(rules.CHRONIC_BASE, 6))
        + F.lit(_units(rules.CHRONIC_SUSCEPTIBILITY, 4)) * susceptible
        + F.lit(_units(rules.CHRONIC_LOAD, 2)) * load
    )
    return F.least(F.greatest(raw, F.lit(0)), F.lit(_units(rules.CHRONIC_LIMIT, 6)))


def chronic_boost(row_id: Column, millionths: Column) -> Column:
    """Extra points with the given probability, else 0.

    The draw is a hash of the row's id: the same in any run, partitioning or retry.
    """
    low, high = rules.CHRONIC_UPLIFT
    hit = draw(rules.DRAW_SEED, row_id) % 1_000_000 < millionths
    points = F.lit(low) + draw(rules.DRAW_SEED + 1, row_id) % (high - low + 1)
    return F.when(hit, points).otherwise(F.lit(0)).cast("long")
