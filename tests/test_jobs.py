"""The way from base tables to gold as one job, and the jobs started by name."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterlake.jobs import gold as gold_job, land as land_job, silver as silver_job
from rosterlake.plans import queries, workforce
from rosterlake.session import LakeLayout
from rosterlake.sources import sample_tables as sample, tables


def rows(df, names):
    return sorted(map(str, df.select(*names).collect()))


def test_base_tables_to_gold_as_the_queries(spark, folder, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    base = queries.Base(spark, folder)
    built = workforce.build_silver(
        spark, layout, base.staff, base.all_shifts, sample.assignments, base.raw_requests, sample.WINDOW_END
    )
    assert len(built) == 4
    made = workforce.build_gold(spark, layout, date(1992, 1, 1), date(2001, 12, 31))
    assert len(made) == 7
    for name in ("fact_burnout", "fact_overtime", "fact_leave"):
        expected = queries.QUERIES[name](spark, folder)
        found = tables.read_silver(spark, layout.gold(name))
        assert set(found.columns) == set(expected.columns)
        assert rows(found, expected.columns) == rows(expected, expected.columns)
    nights = queries.QUERIES["staff_female_night_backfill"](spark, folder)
    found = tables.read_silver(spark, layout.gold("dim_staff"))
    assert rows(found, nights.columns) == rows(nights, nights.columns)


def test_nothing_is_written_without_staff(spark, folder, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    base = queries.Base(spark, folder)
    nobody = base.staff.withColumn("status", F.lit("Inactive"))
    with pytest.raises(ValueError, match="no Active staff"):
        workforce.build_silver(
            spark, layout, nobody, base.all_shifts, sample.assignments, base.raw_requests, sample.WINDOW_END
        )
    assert not (tmp_path / "lake").exists()


def test_jobs_by_name(spark, tmp_path):
    config = tmp_path / "lake.json"
    layers = {"bronze": "b", "silver": "s", "gold": "g"}
    storage = {"root": str(tmp_path / "lake"), "table_format": "parquet"}
    config.write_text(json.dumps({"storage": storage, "layers": layers, "local_source": str(tmp_path / "in")}))
    for name in ("one", "two"):
        spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, x string").write.parquet(
            str(tmp_path / "in" / f"{name}.parquet")
        )
    assert land_job.main(["--config", str(config)]) == ["one", "two"]
    assert land_job.main(["two", "--config", str(config)]) == ["two"]
    path = silver_job.main(["two", "--keys", "id", "--config", str(config)])["two"]
    assert tables.read_silver(spark, path).count() == 2
    with pytest.raises(SystemExit):
        silver_job.main(["two", "--config", str(config)])
    with pytest.raises(SystemExit):
        gold_job.main(["soon", "2024-01-01", "--config", str(config)])
    sizes = tables.table_sizes(spark, {"one": str(tmp_path / "in" / "one.parquet")}).collect()
    files = list((tmp_path / "in" / "one.parquet").glob("part-*.parquet"))
    assert [tuple(r) for r in sizes] == [("one", len(files), sum(f.stat().st_size for f in files))]


def test_an_unknown_format_fails_by_its_name(spark, tmp_path):
    with pytest.raises(Exception, match="nosuchformat"):
        tables.write_silver(spark.range(1), str(tmp_path / "t"), "nosuchformat")
