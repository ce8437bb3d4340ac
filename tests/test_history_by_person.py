"""The history of a shift by person: the full shifts are shuffled once."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from rosterlake.operators import history
from rosterlake.plans import queries


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plain_plans(spark):
    """Plans as they are run, without adaptive changes and broadcasts."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_timesheet_moves_shifts_once(spark, folder, plain_plans):
    """The shifts with the day's cases go by person; the cases are added up before."""
    plan = plan_of(queries.QUERIES["timesheet_enriched"](spark, folder))
    assert plan.count("Exchange ") == 2 and "Join" not in plan


def shifts_of(spark, rows):
    return spark.createDataFrame(
        rows,
        "timesheet_id long, staff_id long, shift_date date, shift_start timestamp_ntz, "
        "shift_end timestamp_ntz, shift_duration_hours long, shift_type string",
    )


@pytest.mark.parametrize("bits", [0, 16])
def test_days_with_cases_only_are_no_worked_days(spark, monkeypatch, bits):
    """Cases on a day without a shift neither close a gap in a streak nor come between two shifts."""
    monkeypatch.setattr(history, "BLOCK_BITS", bits)
    first = datetime(2024, 1, 1, 19)
    rows = []
    for k in (0, 1, 2, 4, 5, 6):
        start = first + timedelta(days=k) - timedelta(hours=12 * (k == 4))
        rows.append((k, 1, start.date(), start, start + timedelta(hours=12), 12, "Day" if k == 4 else "Night"))
    rows += [(20, None, first.date(), first, first, 12, "Day"), (21, 1, None, None, None, 12, "Night")]
    cases = spark.createDataFrame(
        [(1, date(2024, 1, 4), 9, 9), (1, date(2024, 1, 5), 2, 3), (2, date(2024, 1, 5), 9, 9)],
        "staff_id long, shift_date date, critical_cases long, emergency_cases long",
    )
    found = {r.timesheet_id: r for r in history.with_history(shifts_of(spark, rows), cases).collect()}
    assert sorted(found) == [0, 1, 2, 4, 5, 6, 20, 21]
    assert {k for k, r in found.items() if r.night_to_day_flip_flag} == {4}
    assert not any(r.consecutive_days_flag for r in found.values())
    assert {k: (r.critical_cases, r.emergency_cases) for k, r in found.items() if r.critical_cases} == {4: (2, 3)}
    # gaps of 12 and 24 hours
    assert {k for k, r in found.items() if r.back_to_back_12h_flag} == {1, 2, 4, 5, 6}


def test_only_crowded_people_go_by_blocks(spark, monkeypatch):
    """One person above the limit, the others below: flags as without a limit."""
    rng = random.Random(11)
    rows = []
    for k in range(600):
        start = datetime(2024, 1, 1, rng.choice([7, 19])) + timedelta(days=rng.randrange(60))
        person = rng.choice([1, 1, 1, 2, 3, 4, None])
        hours = rng.choice([8, 12, 13])
        kind = "Day" if start.hour == 7 else "Night"
        rows.append((k, person, start.date(), start, start + timedelta(hours=hours), hours, kind))
    shifts = shifts_of(spark, rows)
    cases = shifts.select("staff_id", "shift_date").dropna().distinct().selectExpr(
        "staff_id", "shift_date", "staff_id as critical_cases", "0L as emergency_cases"
    )
    wanted = history.with_history(shifts, cases)
    monkeypatch.setattr(history, "BLOCK_BITS", 7)
    assert history._crowded(shifts) is not None
    found = history.with_history(shifts, cases).select(*wanted.columns)
    assert found.count() == 600
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
