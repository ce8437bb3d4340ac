"""Silver rows by blocks of keys give the rows that keys give, and are not sorted before the shuffle."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterlake.operators import cleaning
from rosterlake.sources import lake


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


@pytest.mark.parametrize("crowded", [4, 1 << 16])
@pytest.mark.parametrize("kind", ["long", "string", "date", "two"])
def test_blocks_keep_the_rows_that_keys_keep(spark, monkeypatch, kind, crowded):
    """Many copies of one key, null keys, short and long texts; blocks above and below the limit."""
    monkeypatch.setattr(cleaning, "CROWDED_ROWS", crowded)
    monkeypatch.setattr(cleaning, "SLOTS", 64)
    rng = random.Random(3)
    made = [None if rng.random() < 0.1 else rng.choice([7, rng.randrange(9000)]) for _ in range(3000)]
    rows = spark.createDataFrame([(k, rng.randrange(50), str(rng.randrange(9))) for k in made], "k long, a long, b string")
    key = {
        "long": F.col("k") - 4000,
        "string": F.when(F.col("k") % 2 == 0, F.format_string("ID_%08d", "k")).otherwise(F.substring(F.col("k").cast("string"), 3, 4)),
        "date": F.date_add(F.lit(date(2000, 1, 1)), F.col("k").cast("int")),
        "two": F.col("k") % 100,
    }[kind]
    rows = rows.withColumn("key", key).withColumn("part", F.col("k") % 3).drop("k")
    keys = ["part", "key"] if kind == "two" else ["key"]
    order = ["a", "b", "part"]
    found = cleaning.dedup_in_blocks(rows, keys, order)
    wanted = cleaning.dedup_by_key(rows, keys, order)
    assert found.columns == wanted.columns and found.count() == wanted.count() > 90
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    assert ("Partial" in plan_of(found)) == (crowded == 4)


def test_silver_rows_are_not_sorted_before_the_shuffle(spark, plain_plans):
    rows = spark.range(5000).select(F.format_string("A_%08d", "id").alias("assignment_id"), (F.col("id") % 7).alias("x"))
    plan = plan_of(lake.clean_for_silver(rows, ["assignment_id"]))
    assert plan.count("Exchange ") == 1 and "Sort" in plan
    assert "Sort" not in plan.split("Exchange ")[1]


def test_copies_of_one_row_go_by_their_key(spark, monkeypatch):
    """A third of the rows is one key: each task sends at most one of them."""
    monkeypatch.setattr(cleaning, "CROWDED_ROWS", 1 << 10)
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") * 1000).alias("key"), "id")
    kept = cleaning.dedup_in_blocks(rows, ["key"], ["id"])
    assert "row_number(), 1, Partial" in plan_of(kept)
    assert kept.count() == 40_001 and kept.where("key = 1").first().id == 0
