"""Skew-safe forms against plain loops, and results that must not depend on partitioning."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rosterlake.functions import ids
from rosterlake.operators import assignments, history, joins, leave, numbering

END = date(2024, 4, 30)


def first_free(start, duration, worked):
    """The rule as it reads: the first of the shifts by 0, 1, ... 119 days whose window, cut at the
    end of the calendar, shares no day with the worked ones; 120 days if there is none."""

    def window(moved):
        first = start if moved == 0 else min(start + timedelta(moved), END)
        last = min((first if moved else start) + timedelta(duration), END)
        return first, last

    def is_free(moved):
        first, last = window(moved)
        days = {first + timedelta(k) for k in range((last - first).days + 1)}
        return days.isdisjoint(worked)

    moved = next((k for k in range(120) if is_free(k)), 120)
    return (moved, *window(moved))


@pytest.mark.parametrize("seed,density", [(1, 0.9), (2, 0.5), (3, 0.15), (4, 0.99)])
def test_leave_moves_to_the_first_free_window(spark, seed, density):
    rng = random.Random(seed)
    calendar = [date(2023, 10, 1) + timedelta(k) for k in range(213)]
    worked = {p: {d for d in calendar if rng.random() < density} for p in range(12)}
    worked[0] = set()
    worked[1] = {END}
    worked[2] = set(calendar)
    worked[3] = {d for d in calendar if d != END}
    worked[4] = {d for d in calendar if d < END - timedelta(3)}
    leaves = [
        (n, rng.randrange(13), rng.choice(calendar), rng.randint(1, 14)) for n in range(400)
    ] + [(400 + n, p, END, 5) for n, p in enumerate(range(13))]
    leaves += [(500, 0, END + timedelta(2), 3), (501, 2, END + timedelta(2), 3), (502, None, END, 3)]
    # 119 and 120 steps
    worked[20] = {date(2023, 10, 1) + timedelta(k) for k in range(119)}
    worked[21] = {date(2023, 10, 1) + timedelta(k) for k in range(120)}
    leaves += [(510, 20, date(2023, 10, 1), 2), (511, 21, date(2023, 10, 1), 2)]
    lines = [(p, d) for p, days in worked.items() for d in days] or [(0, END)]
    days = spark.createDataFrame(lines, "staff_id long, shift_date date")
    asked = spark.createDataFrame(
        leaves, "leave_id long, staff_id long, leave_start date, duration_days int"
    )
    found = {r.leave_id: r for r in leave.resolve_leave_conflicts(asked, days, END).collect()}
    assert len(found) == len(leaves)
    for number, person, start, duration in leaves:
        steps, s, e = first_free(start, duration, worked.get(person, set()))
        row = found[number]
        assert (row.moved_days, row.leave_start, row.leave_end) == (steps, s, e), (person, start)


def test_conflicts_as_the_loop(spark):
    rng = random.Random(5)
    calendar = [date(2024, 1, 1) + timedelta(k) for k in range(100)]
    worked = {(p, d) for p in range(5) for d in calendar if rng.random() < 0.1}
    leaves = []
    for n in range(300):
        start = rng.choice(calendar)
        leaves.append((n, rng.randrange(6), start, start + timedelta(rng.randrange(12))))
    asked = spark.createDataFrame(
        leaves, "leave_id long, staff_id long, leave_start date, leave_end date"
    )
    days = spark.createDataFrame(list(worked), "staff_id long, shift_date date")
    found = {r.leave_id for r in leave.leave_shift_conflicts(asked, days).collect()}
    expected = {
        n for n, p, s, e in leaves
        if any((p, s + timedelta(k)) in worked for k in range((e - s).days + 1))
    }
    assert found == expected


def random_shifts(seed, rows=700, people=4):
    """Many shifts per day for few people; person 0 holds a third of them."""
    rng = random.Random(seed)
    made = []
    for number in rng.sample(range(5_000), rows):
        person = 0 if rng.random() < 0.33 else rng.choice([None, *range(people)])
        kind = rng.choice(["Day", "Night"])
        day = date(2024, 1, 1) + timedelta(rng.randrange(40))
        start = datetime(day.year, day.month, day.day, 7 if kind == "Day" else 19)
        hours = rng.randint(8, 14)
        made.append((number, person, day, start, start + timedelta(hours=hours), hours, kind))
    return made


SCHEMA = (
    "timesheet_id long, staff_id long, shift_date date, shift_start timestamp_ntz, "
    "shift_end timestamp_ntz, shift_duration_hours long, shift_type string"
)


def history_by_loop(rows):
    """(flip, back to back, consecutive) per shift id."""
    people = defaultdict(list)
    for row in rows:
        people[row[1]].append(row)
    found = {}
    for person, mine in people.items():
        days = sorted({row[2] for row in mine})
        length = {}
        for day in days:
            first = last = day
            while first - timedelta(1) in days:
                first -= timedelta(1)
            while last + timedelta(1) in days:
                last += timedelta(1)
            length[day] = (last - first).days + 1
        flips, follows = set(), set()
        by_date = sorted(mine, key=lambda r: (r[2], r[0]))
        for before, row in zip(by_date, by_date[1:]):
            if before[6] == "Night" and row[6] == "Day":
                flips.add(row[0])
        by_start = sorted(mine, key=lambda r: (r[3], r[4], r[0]))
        for before, row in zip(by_start, by_start[1:]):
            gap = (row[3] - before[4]).total_seconds() / 3600
            if before[5] >= 12 and row[5] >= 12 and 0 <= gap <= 24:
                follows.add(row[0])
        for row in mine:
            known = person is not None
            found[row[0]] = (
                int(known and row[0] in flips),
                int(known and row[0] in follows),
                int(known and length[row[2]] > 4),
            )
    return found


@pytest.mark.parametrize("bits", [0, 3, 16])
@pytest.mark.parametrize("as_text", [False, True])
def test_history_as_the_loop(spark, monkeypatch, bits, as_text):
    monkeypatch.setattr(history, "BLOCK_BITS", bits)
    monkeypatch.setattr(numbering, "BLOCK_BITS", bits)
    rows = random_shifts(7 + bits)
    df = spark.createDataFrame(rows, SCHEMA)
    if as_text:
        df = df.withColumn("timesheet_id", ids.format_id("TS_", F.col("timesheet_id")))
    cases = df.select("staff_id", "shift_date").dropna().distinct().where("staff_id = 1").withColumns(
        {"critical_cases": F.lit(2).cast("long"), "emergency_cases": F.lit(1).cast("long")}
    )
    flags = ["night_to_day_flip_flag", "back_to_back_12h_flag", "consecutive_days_flag"]
    together = history.with_history(df, cases)
    apart = (
        df.transform(history.with_night_to_day_flip)
        .transform(history.with_back_to_back)
        .transform(history.with_consecutive_days)
    )
    expected = history_by_loop(rows)
    for found in (together, apart):
        seen = {}
        for row in found.collect():
            number = int(row.timesheet_id[3:]) if as_text else row.timesheet_id
            seen[number] = tuple(row[name] for name in flags)
        assert seen == expected
    assert sum(sum(v) for v in expected.values()) > 50
    for row in together.collect():
        assert (row.critical_cases, row.emergency_cases) == ((2, 1) if row.staff_id == 1 else (0, 0))


@pytest.mark.parametrize("shape", ["plain words", "shared digits", "missing"])
def test_history_of_ids_of_any_shape(spark, shape):
    """Ids without digits, ids that share their digits, and no ids: right flags, no row twice."""
    rows = []
    for person in range(3):
        for k in range(40):
            day = date(2024, 1, 1) + timedelta(k)
            kind = "Day" if (k + person) % 3 else "Night"
            start = datetime(day.year, day.month, day.day, 7 if kind == "Day" else 19)
            name = {"plain words": f"shift {'abcd'[person]}{chr(97 + k % 26)}{chr(97 + k // 26)}", "missing": None}
            number = name.get(shape, f"{'ABC'[person]}_{k}")
            rows.append((number, person, day, start, start + timedelta(hours=12), 12, kind))
    df = spark.createDataFrame(rows, SCHEMA.replace("timesheet_id long", "timesheet_id string"))
    expected = history_by_loop([(k, *row[1:]) for k, row in enumerate(rows)])
    flags = ["night_to_day_flip_flag", "back_to_back_12h_flag", "consecutive_days_flag"]
    apart = (
        df.transform(history.with_night_to_day_flip)
        .transform(history.with_back_to_back)
        .transform(history.with_consecutive_days)
    )
    cases = df.select("staff_id", "shift_date").distinct().withColumns(
        {"critical_cases": F.lit(2).cast("long"), "emergency_cases": F.lit(1).cast("long")}
    )
    places = {(row[1], row[2]): k for k, row in enumerate(rows)}
    for found in (apart, history.with_history(df, cases)):
        seen = {places[(r.staff_id, r.shift_date)]: tuple(r[f] for f in flags) for r in found.collect()}
        assert seen == expected and found.count() == len(rows)
    gaps = history.with_gap_hours(df).collect()
    assert len(gaps) == len(rows) and sum(r.gap_hours is None for r in gaps) == 3
    assert {r.gap_hours for r in gaps} <= {None, 0.0, 12.0, 24.0}


def test_attach_keeps_facts_without_a_key(spark):
    facts = spark.createDataFrame(
        [(n, None if n % 11 == 0 else (0 if n % 3 else n % 7)) for n in range(500)], "id long, k long"
    )
    table = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k long, v string")
    found = {r.id: r.v for r in joins.attach(facts, table, ["k"]).collect()}
    keys = {r.id: r.k for r in facts.collect()}
    assert found == {n: f"v{k}" if k is not None and k < 5 else None for n, k in keys.items()}
    kept = joins.keep_matching(facts, table, ["k"]).collect()
    assert sorted(r.id for r in kept) == sorted(n for n, v in found.items() if v)


@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_are_gapless_and_do_not_depend_on_partitions(spark, parts):
    rng = random.Random(3)
    rows = [(rng.choice([None, rng.randrange(600)]), rng.choice("abc"), n) for n in range(900)]
    df = spark.createDataFrame(rows, "a long, b string, c long").repartition(parts)
    found = numbering.number_rows(df, ["a", "b", "c"]).collect()
    in_order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1], r[2]))
    expected = {row: n for n, row in enumerate(in_order, 1)}
    assert {(r.a, r.b, r.c): r.row_no for r in found} == expected


def test_repeated_rows_and_empty_tables_are_numbered(spark):
    df = spark.createDataFrame([("x",)] * 7 + [(None,)] * 2, "a string")
    found = numbering.number_rows(df, ["a"]).collect()
    assert sorted(r.row_no for r in found) == list(range(1, 10))
    assert sorted(r.row_no for r in found if r.a is None) == [1, 2]
    assert numbering.number_rows(df.where("a = 'none'"), ["a"]).count() == 0


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_row_before(spark, monkeypatch, bits):
    monkeypatch.setattr(numbering, "BLOCK_BITS", bits)
    rows = [(n * 7919 % 100, f"v{n}") for n in range(100)]
    df = spark.createDataFrame(rows, "a long, b string").repartition(5)
    found = {r.a: r.p for r in numbering.with_row_before(df, ["a"], ["a", "b"], "p").collect()}
    by_a = dict(rows)
    assert found.pop(0) is None and len(found) == 99
    assert {a: tuple(p) for a, p in found.items()} == {a: (a - 1, by_a[a - 1]) for a in found}


def test_draw_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    one = df.repartition(1).select("id", ids.draw(42, F.col("id")).alias("u"))
    many = df.repartition(9).select("id", ids.draw(42, F.col("id")).alias("u"))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    share = one.where("u % 1000000 < 250000").count()
    assert 200 < share < 300


def test_case_counts_reach_every_shift_of_the_day(spark):
    worked = spark.createDataFrame(
        [(1, 1, date(2024, 1, 1)), (2, 1, date(2024, 1, 1)), (3, 1, date(2024, 1, 2)), (4, None, None)],
        "timesheet_id long, staff_id long, shift_date date",
    )
    cases = spark.createDataFrame(
        [(1, date(2024, 1, 1), 1, "Emergency"), (1, date(2024, 1, 1), 0, "Emergency"),
         (1, date(2024, 1, 1), 1, "Routine"), (None, date(2024, 1, 1), 1, "Routine")],
        "staff_id long, assignment_date date, critical_flag long, case_type string",
    )
    counted = assignments.with_case_counts(worked, assignments.day_case_counts(cases))
    found = {r.timesheet_id: (r.critical_cases, r.emergency_cases) for r in counted.collect()}
    assert found == {1: (2, 2), 2: (2, 2), 3: (0, 0), 4: (0, 0)}


def test_conflicts_at_the_edges_of_blocks(spark):
    """Days before 1970, first and last days of a block, leaves over several blocks, missing values."""
    zero = date(1970, 1, 1)
    marks = [-65, -64, -1, 0, 63, 64, 127, 640]
    days = [(k, zero + timedelta(mark)) for k, mark in enumerate(marks)] * 2 + [(None, zero), (0, None)]
    worked = spark.createDataFrame(days, "staff_id long, shift_date date")
    leaves, expected = [], set()
    for k, mark in enumerate(marks):
        for first, last in [(-1, -1), (0, 0), (1, 1), (-200, 200), (-200, -1), (1, 200), (1, -1), (None, 0), (0, None)]:
            if first is not None and last is not None and first <= 0 <= last:
                expected.add(len(leaves))
            ends = (None if at is None else zero + timedelta(mark + at) for at in (first, last))
            leaves.append((len(leaves), k, *ends))
    leaves += [(1000, None, zero, zero), (1001, 99, zero, zero)]
    asked = spark.createDataFrame(leaves, "leave_id long, staff_id long, leave_start date, leave_end date")
    flagged = leave.with_conflict_flag(asked, worked).collect()
    assert len(flagged) == len(leaves)
    assert {r.leave_id for r in flagged if r.conflict_flag} == expected
    assert leave.with_conflict_flag(asked, worked.limit(0)).where("conflict_flag = 1").isEmpty()
