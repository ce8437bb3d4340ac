"""Reading pandas files, landing, silver jobs and gold on a local folder."""

from __future__ import annotations

import json
from datetime import date, datetime

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rosterlake import schemas, session
from rosterlake.plans import queries as plans
from rosterlake.plans.workforce import build_gold
from rosterlake.session import LakeLayout
from rosterlake.sources import lake, tables, workspace


def timesheet_frame(rows=3):
    start = datetime(2024, 3, 1, 7)
    return pd.DataFrame(
        {
            "timesheet_id": [f"TS_{i:08d}" for i in range(1, rows + 1)],
            "staff_id": ["STF_0000001"] * rows,
            "shift_date": [date(2024, 3, 1)] * rows,
            "shift_start": pd.to_datetime([start] * rows).astype("datetime64[ns]"),
            "shift_end": pd.to_datetime([datetime(2024, 3, 1, 17)] * rows).astype("datetime64[ns]"),
            "shift_type": ["Day"] * rows,
            "shift_duration_hours": [10] * rows,
            "overtime_hours": [2.0] * rows,
            "break_minutes": [30] * rows,
            "department_override": ["ICU"] * rows,
            "logged_hours_flag": [True] * rows,
            "burnout_score": [80] * rows,
            "burnout_risk_label": ["Critical"] * rows,
            "surge_period_flag": [1] * rows,
            "consecutive_days_flag": [0] * rows,
            "back_to_back_12h_flag": [0] * rows,
            "night_to_day_flip_flag": [0] * rows,
            "female_night_flag": [0] * rows,
            "overtime_multiplier": [1.5] * rows,
            "overtime_pay": [1050.0] * rows,
        }
    )


def staff_frame():
    return pd.DataFrame(
        {
            "staff_id": ["STF_0000001", "STF_0000002"], "staff_name": ["A B", "C D"],
            "gender": ["Female", "Male"], "role": ["Nurse", "Doctor"],
            "experience_level": ["Junior", "Senior"], "department": ["ICU", "ER"],
            "hire_date": [date(2015, 1, 1), date(2016, 1, 1)],
            "employment_type": ["Full-time/Female", "Contract/Male"],
            "shift_preference": ["Day", "Any"], "status": ["Active", "Active"],
            "base_location": ["North Clinic", "East Annex"], "per_hour_rate": [350.0, 1120.0],
            "salary_band": ["Band C", "Band E"], "night_shift_female_flag": [0, 0],
        }
    )


def leave_frame():
    return pd.DataFrame(
        {
            "leave_id": ["LV_00000002", "LV_00000001"], "staff_id": ["STF_0000001"] * 2,
            "leave_start": [date(2024, 5, 1)] * 2, "leave_end": [date(2024, 5, 11), date(2024, 5, 2)],
            "leave_type": ["Sick", "Study"], "leave_days_count": [10, 1],
            "approval_status": ["Approved"] * 2, "emergency_leave_flag": [False, False],
        }
    )


def assignment_frame():
    return pd.DataFrame(
        {
            "assignment_id": ["ASN_00000001"], "staff_id": ["STF_0000001"],
            "patient_id": ["PAT_100000"], "assignment_date": [date(2024, 3, 1)],
            "severity_level": [3], "department": ["ICU"], "case_type": ["Emergency"],
            "assignment_duration_minutes": [30], "critical_flag": [1], "surge_emergency_flag": [1],
        }
    )


def write_nanoseconds(frame, path):
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), path, version="2.6")
    kinds = {f.name: str(f.type) for f in pq.read_schema(path)}
    assert kinds.get("shift_start", "timestamp[ns]") == "timestamp[ns]"


def test_nanosecond_timestamps(spark, tmp_path):
    path = str(tmp_path / "staff_timesheet.parquet")
    frame = timesheet_frame(4)
    frame["shift_start"] = pd.to_datetime(
        [datetime(2024, 3, 1, 7), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), None]
    ).astype("datetime64[ns]")
    write_nanoseconds(frame, path)
    df = tables.read_table(spark, path, schemas.STAFF_TIMESHEET)
    assert df.schema["shift_start"].dataType.typeName() == "timestamp_ntz"
    assert [r.shift_start for r in df.orderBy("timesheet_id").collect()] == [
        datetime(2024, 3, 1, 7), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1), None,
    ]
    assert df.first().shift_end == datetime(2024, 3, 1, 17)


def test_unsigned_numbers(spark, tmp_path):
    path = str(tmp_path / "dim_date.parquet")
    names = schemas.DIM_DATE.names
    row = [20240101, date(2024, 1, 1), "Monday", 0, 1, 1, "January", 1, 2024, 0, 0]
    table = pa.table({n: [v] for n, v in zip(names, row)})
    place = names.index("week_number")
    table = table.set_column(place, "week_number", pa.array([1], pa.uint32()))
    pq.write_table(table, path)
    df = tables.read_table(spark, path, schemas.DIM_DATE)
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.DIM_DATE]
    assert df.first().week_number == 1


def test_wrong_tables_are_refused(spark, tmp_path):
    path = str(tmp_path / "leave_records.parquet")
    leave_frame().drop(columns=["leave_type"]).to_parquet(path)
    with pytest.raises(schemas.SchemaError, match="leave_type"):
        tables.read_table(spark, path, schemas.LEAVE_RECORDS)
    wrong = leave_frame()
    wrong["leave_start"] = "soon"
    wrong.to_parquet(path)
    with pytest.raises(schemas.SchemaError, match="leave_start"):
        tables.read_table(spark, path, schemas.LEAVE_RECORDS)


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "source"
    (folder / "deeper").mkdir(parents=True)
    write_nanoseconds(pd.concat([timesheet_frame(3), timesheet_frame(2)]), folder / "staff_timesheet.parquet")
    staff_frame().to_parquet(folder / "staff_master.parquet")
    leave_frame().to_parquet(folder / "leave_records.parquet")
    assignment_frame().to_parquet(folder / "patient_assignment.parquet")
    assignment_frame().to_parquet(folder / "deeper" / "hidden.parquet")
    (folder / "notes.txt").write_text("not a table")
    return str(folder)


def test_bronze_to_gold(spark, source, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    landed = lake.land_bronze(spark, source, layout)
    assert landed == ["leave_records", "patient_assignment", "staff_master", "staff_timesheet"]
    assert lake.read_bronze(spark, layout, "staff_timesheet").count() == 5
    lake.land_bronze(spark, source, layout, ["staff_timesheet"])  # replaces
    assert lake.read_bronze(spark, layout, "staff_timesheet").count() == 5

    paths = lake.run_silver_jobs(spark, layout)
    first = tables.read_silver(spark, paths["staff_timesheet"])
    assert first.count() == 3 and "silver_processed_at" in first.columns
    content = sorted(map(str, first.drop("silver_processed_at").collect()))
    lake.run_silver_job(spark, layout, "staff_timesheet")
    again = tables.read_silver(spark, paths["staff_timesheet"])
    assert sorted(map(str, again.drop("silver_processed_at").collect())) == content

    built = build_gold(spark, layout, date(2024, 1, 1), date(2024, 12, 31))
    assert len(built) == 7
    gold = {name: tables.read_silver(spark, layout.gold(name)) for name in built}
    week = gold["fact_burnout"].first()
    assert gold["fact_burnout"].count() == 1
    assert (week.burnout_fact_id, week.staff_id, week.year_week) == (
        "BF_00000001", "STF_0000001", "2024-W09",
    )
    assert (week.total_overtime_hours, week.avg_burnout_score, week.high_burnout_days) == (6.0, 80.0, 3)
    assert (week.worst_burnout_risk, week.role, week.shift_count) == ("Critical", "Nurse", 3)
    assert {r.overtime_fact_id for r in gold["fact_overtime"].collect()} == {
        "OT_00000001", "OT_00000002", "OT_00000003",
    }
    leaves = {r.leave_id: (r.leave_fact_id, r.burnout_leave_flag) for r in gold["fact_leave"].collect()}
    assert leaves == {"LV_00000001": ("LF_00000001", 0), "LV_00000002": ("LF_00000002", 1)}
    assert gold["dim_staff"].count() == 2 and gold["dim_date"].count() == 366


def test_layout_file(tmp_path):
    layout = session.load_layout()
    assert layout.bronze("t") == "s3a://workforce-lake/bronze/t.parquet"
    assert layout.silver("t").endswith("/silver/t") and layout.gold("t").endswith("/gold/t")
    text = session.DEFAULT_CONFIG.read_text()
    assert not {"access_key", "secret_key", "password"} & set(json.loads(text)["storage"])


def test_session_and_workspace(spark):
    assert session.get_session().sparkContext is spark.sparkContext
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = workspace.shared_folder(spark), workspace.shared_folder(spark)
    assert one.startswith(root) and one != two


def test_parquet_write_partitioned(spark, tmp_path):
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    path = str(tmp_path / "t")
    tables.write_parquet(df, path, ["part"])
    tables.write_parquet(df, path, ["part"])
    assert tables.read_table(spark, path).count() == 10
    assert (tmp_path / "t" / "part=0").exists()


def test_every_query_has_a_name_of_its_own():
    assert len(plans.QUERIES) >= 64
