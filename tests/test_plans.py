"""What the plans must and must not contain, and how rows spread when a key is hot."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import assignments, cleaning, history, joins, leave, numbering
from rosterlake.operators.staff import active_staff
from rosterlake.plans import queries

QUERIES = queries.QUERIES
# queries whose every stage is planned lazily and is cheap to plan here
PLANNED = [
    "dedup_by_key", "surrogate_key", "shift_staff_lookup", "overtime_pay", "consecutive_days",
    "back_to_back_12h", "night_to_day_flip", "shift_case_counts", "timesheet_enriched",
    "leave_resolve_conflicts", "leave_shift_conflicts", "fact_burnout", "fact_overtime",
    "fact_leave", "qa_shift_assignment_mismatch",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_pairing(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for unwanted in ("Python", "Pandas", "NestedLoop", "CartesianProduct"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", PLANNED)
def test_one_task_only_adds_up_group_counts(spark, folder, name):
    """A single-partition exchange takes counts of ranges or sums that are already added up."""
    plan = plan_of(QUERIES[name](spark, folder))
    below = re.findall(r"Exchange SinglePartition.*\n(.*)", plan)
    assert all("keys=[_range" in line or "keys=[], functions=[partial_" in line for line in below)


def test_dedup_reduces_before_the_shuffle(spark, folder):
    plan = plan_of(QUERIES["dedup_by_key"](spark, folder))
    after, before = plan.split("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in before and "row_number(), 1, Final" in after


def test_scan_reads_the_needed_columns_only(spark, folder):
    """From a stored table a pass reads its own columns, not the whole rows."""
    plan = plan_of(QUERIES["fact_overtime"](spark, folder))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    widths = sorted(len(columns.split(",")) for columns in scans)
    assert widths[0] <= 3 and widths[-1] < 16
    plan = plan_of(QUERIES["leave_window"](spark, folder))
    assert "o_totalprice" not in plan


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "staff")
    spark.createDataFrame([(1, "Active"), (2, "Inactive")], "staff_id long, status string").write.parquet(path)
    plan = plan_of(active_staff(spark.read.parquet(path)))
    assert "EqualTo(status,Active)" in plan


# --- a third of all rows belongs to one staff member --------------------------

PARTS = 16
ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """Shifts of which a third belongs to staff member 0, and of those a half to one day."""
    number = F.col("id")
    person = F.when(number % 3 == 0, F.lit(0)).otherwise(1 + number % 5000)
    day = F.when((number % 6 == 0), F.lit(date(2024, 3, 1))).otherwise(
        F.date_add(F.lit(date(2024, 1, 1)), ((number / 7).cast("int") % 400).cast("int"))
    )
    base = spark.range(ROWS).select(
        number.alias("timesheet_id"),
        person.cast("long").alias("staff_id"),
        day.alias("shift_date"),
        F.when(number % 5 < 2, "Night").otherwise("Day").alias("shift_type"),
        (8 + number % 6).alias("shift_duration_hours"),
    )
    start = F.timestamp_add(
        "HOUR", F.when(F.col("shift_type") == "Day", 7).otherwise(19), F.col("shift_date").cast("timestamp_ntz")
    )
    return base.withColumn("shift_start", start).withColumn(
        "shift_end", F.timestamp_add("HOUR", F.col("shift_duration_hours"), F.col("shift_start"))
    )


@pytest.fixture
def wide(spark):
    """Many partitions, left as they are, and no join turned into a broadcast."""
    names = {
        "spark.sql.shuffle.partitions": str(PARTS),
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def splitting(spark, wide):
    """As ``wide``, but adaptive, with limits that fit these few rows."""
    names = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def largest_share(df):
    """The largest partition's share of all rows."""
    # the hash needs every column, so that no join can be left out of the plan
    sized = df.select(F.spark_partition_id().alias("p"), F.hash(*df.columns).alias("h"))
    sizes = [r.n for r in sized.groupBy("p").agg(F.count("*").alias("n"), F.max("h")).collect()]
    return max(sizes) / sum(sizes)


def test_a_plain_join_would_be_lopsided(spark, hot, wide):
    table = hot.select("staff_id").distinct().withColumn("x", F.lit(1))
    joined = hot.join(table.hint("merge"), "staff_id", "left")
    assert largest_share(joined) > 0.3


def test_attach_spreads_a_hot_key(spark, hot, splitting):
    table = hot.select("staff_id").distinct().withColumn("x", F.lit(1))
    dealt = hot.repartition(PARTS, "timesheet_id")
    joined = joins.attach(dealt, table, ["staff_id"], grouped=True)
    assert joined.where("x is null").count() == 0 and joined.count() == ROWS
    assert largest_share(joined) < 0.15


def test_history_spreads_a_hot_staff_member(spark, hot, wide, monkeypatch):
    monkeypatch.setattr(history, "BLOCK_BITS", 8)
    monkeypatch.setattr(numbering, "BLOCK_BITS", 8)
    cases = hot.select("staff_id", "shift_date").distinct().withColumns(
        {"critical_cases": F.lit(1).cast("long"), "emergency_cases": F.lit(0).cast("long")}
    )
    done = history.with_history(hot, cases)
    assert done.count() == ROWS
    assert largest_share(done) < 0.15
    assert largest_share(history.with_back_to_back(hot)) < 0.15
    assert largest_share(history.with_night_to_day_flip(hot)) < 0.15


def test_windows_over_a_person_see_days_only(spark, hot, wide):
    streaks = history.streak_days(cleaning.distinct_staff_days(hot))
    assert streaks.where("staff_id = 0").count() <= 401


def largest_range(placed):
    sizes = [r["count"] for r in placed.groupBy("_range").count().collect()]
    return max(sizes) / sum(sizes)


def test_shifts_of_a_hot_person_are_cut_into_ranges(spark, hot, wide, monkeypatch):
    monkeypatch.setattr(numbering, "BLOCK_BITS", 8)
    placed = numbering.in_ranges(hot, ["staff_id", "shift_start", "shift_end", "timesheet_id"])
    assert largest_range(placed) < 0.15
    assert largest_share(history.with_gap_hours(hot)) < 0.15


@pytest.mark.parametrize("shape", ["number", "text", "one value"])
def test_numbering_spreads_rows(spark, wide, shape):
    """Numbers, texts without closing digits, and a third of all rows with one value."""
    number = F.col("id")
    letters = F.translate(F.lpad(number.cast("string"), 6, "0"), "0123456789", "qwertyuiop")
    value = {
        "number": number,
        "text": letters,
        "one value": F.when(number % 3 == 0, F.lit(0)).otherwise(number),
    }[shape]
    rows = spark.range(0, 20_000, 1, PARTS).select(value.alias("a"), number.alias("b"))
    assert largest_range(numbering.in_ranges(rows, ["a", "b"])) < 0.15
    first, again = (numbering.number_rows(rows, ["a", "b"]) for _ in range(2))
    assert first.agg(F.count_distinct("row_no"), F.min("row_no"), F.max("row_no")).first() == (20_000, 1, 20_000)
    assert first.exceptAll(again).isEmpty()


def test_back_to_back_takes_few_shuffles(spark, folder, wide):
    """After the shifts are written in order: counts per range, their sum, and one window."""
    plan = plan_of(QUERIES["back_to_back_12h"](spark, folder))
    assert plan.count("Exchange ") <= 5 and "collect_list" not in plan
    assert "collect_list" not in plan_of(QUERIES["timesheet_enriched"](spark, folder))


def test_leaves_of_a_hot_staff_member(spark, hot, splitting):
    """A third of the leaves asks for the same days for the same person."""
    number = F.col("id")
    asked = spark.range(0, 30_000, 1, PARTS).select(
        number.alias("leave_id"),
        F.when(number % 3 == 0, 0).otherwise(number % 5000).cast("long").alias("staff_id"),
        F.when(number % 3 == 0, F.lit(date(2024, 2, 1)))
        .otherwise(F.date_add(F.lit(date(2024, 1, 1)), (number % 300).cast("int")))
        .alias("leave_start"),
        F.when(number % 3 == 0, 4).otherwise(1 + number % 14).cast("int").alias("duration_days"),
    )
    worked = leave.worked_days(hot, asked)
    moved = leave.resolve_leave_conflicts(asked, worked, date(2025, 3, 1))
    assert moved.count() == 30_000
    assert largest_share(moved) < 0.15


def test_copies_of_one_row_do_not_meet_in_one_task(spark, wide):
    """Each task sends at most one row of a key."""
    copies = spark.range(40_000).withColumn("key", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    kept = cleaning.dedup_by_key(copies, ["key"], ["id"])
    assert "Partial" in plan_of(kept)
    assert kept.count() == 1 + copies.where("key <> 0").count()


def test_case_counts_are_added_up_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 1), 1, "Emergency")],
        "staff_id long, assignment_date date, critical_flag long, case_type string",
    )
    plan = plan_of(assignments.day_case_counts(df))
    assert "partial_sum" in plan.split("Exchange hashpartitioning")[1]


def test_weekly_facts_are_added_up_before_the_shuffle(spark, folder):
    plan = plan_of(QUERIES["fact_burnout"](spark, folder))
    assert "HashAggregate" in plan and "partial_sum(surge_period_flag" in plan
    assert "partial_sum(shift_duration_hours" in plan
    weekly = [line for line in plan.splitlines() if "partial_avg(burnout_score" in line]
    assert weekly and all("SortAggregate" not in line for line in weekly)
