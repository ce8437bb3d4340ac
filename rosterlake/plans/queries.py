"""One query per operator over the given tables: (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.functions.ids import format_id
from rosterlake.operators import (
    assignments as asg,
    burnout,
    cleaning,
    dims,
    facts,
    history,
    leave,
    numbering,
    quality,
    shifts as shf,
    staff as stf,
)
from rosterlake.operators.joins import keep_matching
from rosterlake.plans import workforce
from rosterlake.session import LakeLayout, prepare
from rosterlake.sources import lake, sample_tables as sample, tables
from rosterlake.sources.workspace import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ID = "timesheet_id"
SHIFT = ["timesheet_id", "staff_id", "shift_date"]


@dataclass
class Base:
    """The base tables of one folder, each built when first asked for."""

    spark: SparkSession
    folder: str

    @cached_property
    def lines(self) -> DataFrame:
        return sample.raw_lines(self.spark, self.folder)

    @cached_property
    def staff(self) -> DataFrame:
        return sample.staff_master(self.spark, self.folder)

    @cached_property
    def all_shifts(self) -> DataFrame:
        """Shifts, one per key, without staff columns."""
        return sample.shifts(self.spark, self.folder)

    @cached_property
    def plain(self) -> DataFrame:
        """Shifts of Active staff as they come in, without derived columns."""
        return keep_matching(self.all_shifts, stf.active_staff(self.staff), ["staff_id"])

    @cached_property
    def shifts(self) -> DataFrame:
        """Shifts of Active staff with the columns of the shift itself."""
        return workforce.active_shifts(self.all_shifts, self.staff)

    def stored(self) -> Base:
        """The same tables with the Active shifts written to the shared folder and read back.

        For queries that pass over the shifts several times: cleaning and staff lookup run
        once, and each pass reads only the columns it needs.
        """
        path = f"{shared_folder(self.spark)}/shifts"
        tables.write_parquet(self.shifts, path)
        base = Base(self.spark, self.folder)
        base.staff = self.staff
        base.shifts = base.plain = tables.read_table(self.spark, path)
        return base

    @cached_property
    def assignments(self) -> DataFrame:
        return sample.assignments(self.shifts)

    @cached_property
    def scored(self) -> DataFrame:
        return workforce.scored_shifts(self.shifts, self.assignments)

    @cached_property
    def timesheet(self) -> DataFrame:
        return self.scored.select(*workforce.TIMESHEET_COLUMNS)

    @cached_property
    def requests(self) -> DataFrame:
        return sample.leave_requests(self.spark, self.folder, self.staff)

    @cached_property
    def raw_requests(self) -> DataFrame:
        return sample.raw_leave_requests(self.spark, self.folder)

    @cached_property
    def raw_assignments(self) -> DataFrame:
        return sample.raw_assignments(self.spark, self.folder)

    @cached_property
    def worked(self) -> DataFrame:
        return leave.worked_days(self.plain, self.requests)

    @cached_property
    def moved(self) -> DataFrame:
        return leave.resolve_leave_conflicts(self.requests, self.worked, sample.WINDOW_END)

    @cached_property
    def leaves(self) -> DataFrame:
        return workforce.leave_records(self.requests, self.plain, sample.WINDOW_END)


def query(build: Callable[[Base], DataFrame]) -> Callable[[Base], DataFrame]:
    """Register a function of the base tables under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Base(prepare(spark), folder))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


# --- sources and sinks -------------------------------------------------------


@query
def bronze_read(b: Base) -> DataFrame:
    return b.lines


@query
def parquet_write(b: Base) -> DataFrame:
    path = f"{shared_folder(b.spark)}/staff_timesheet.parquet"
    tables.write_parquet(b.plain, path)
    return tables.read_table(b.spark, path)


@query
def bronze_land(b: Base) -> DataFrame:
    """Land every table of the folder and count the rows that bronze then holds."""
    layout = LakeLayout(shared_folder(b.spark))
    landed = lake.land_bronze(b.spark, b.folder, layout)
    counts = [
        lake.read_bronze(b.spark, layout, name)
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in landed
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def silver_write(b: Base) -> DataFrame:
    path = LakeLayout(shared_folder(b.spark)).silver("orders")
    tables.write_silver(sample.sales_table(b.spark, b.folder, "orders"), path)
    return tables.read_silver(b.spark, path)


def _delivered_twice(rows: DataFrame, number: str, corrected: str, wrong) -> DataFrame:
    """Every fifth row comes a second time, later in order and with another value."""
    copies = F.when(F.col(number) % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    again = rows.withColumn("_copy", F.explode(copies))
    value = F.when(F.col("_copy") == 2, wrong).otherwise(F.col(corrected))
    return again.withColumn(corrected, value).drop("_copy")


def _through_silver(b: Base, table: str, bronze: DataFrame) -> DataFrame:
    """Write a bronze table, run its silver job, read the silver table without the stamp."""
    layout = LakeLayout(shared_folder(b.spark))
    tables.write_parquet(bronze, layout.bronze(table))
    path = lake.run_silver_job(b.spark, layout, table)
    return tables.read_silver(b.spark, path).drop("silver_processed_at")


@query
def silver_staff_master(b: Base) -> DataFrame:
    rows = _delivered_twice(b.staff, "staff_id", "base_location", F.lit("~unknown"))
    named = rows.withColumn("staff_id", format_id("STF_", F.col("staff_id")))
    return _through_silver(b, "staff_master", named)


@query
def silver_staff_timesheet(b: Base) -> DataFrame:
    b = b.stored()
    rows = _delivered_twice(
        b.timesheet, "timesheet_id", "break_minutes", F.col("break_minutes") + 100
    )
    named = rows.withColumns(
        {
            "timesheet_id": format_id("TS_", F.col("timesheet_id")),
            "staff_id": format_id("STF_", F.col("staff_id")),
        }
    )
    return _through_silver(b, "staff_timesheet", named)


@query
def silver_patient_assignment(b: Base) -> DataFrame:
    rows = _delivered_twice(
        b.assignments.drop("timesheet_id"), "assignment_id", "severity_level", F.lit(9).cast("long")
    )
    named = rows.withColumns(
        {
            "assignment_id": format_id("ASN_", F.col("assignment_id")),
            "staff_id": format_id("STF_", F.col("staff_id")),
        }
    )
    return _through_silver(b, "patient_assignment", named)


@query
def silver_leave_records(b: Base) -> DataFrame:
    rows = _delivered_twice(b.leaves, "leave_id", "leave_type", F.lit("~unknown"))
    named = rows.withColumns(
        {
            "leave_id": format_id("LV_", F.col("leave_id")),
            "staff_id": format_id("STF_", F.col("staff_id")),
        }
    )
    return _through_silver(b, "leave_records", named)


# --- cleaning ----------------------------------------------------------------


@query
def dedup_by_key(b: Base) -> DataFrame:
    return cleaning.dedup_by_key(b.lines, sample.LINE_KEY, sample.line_order())


@query
def silver_stamp(b: Base) -> DataFrame:
    """The stamp differs from run to run, so the query says whether it is this run's, and one."""
    stamped = cleaning.silver_stamp(dedup_by_key(b))
    is_now = F.col("silver_processed_at") == F.current_timestamp()
    return stamped.withColumn("stamped_by_this_run", is_now).drop("silver_processed_at")


@query
def dedup_staff_attrs(b: Base) -> DataFrame:
    return cleaning.dedup_staff_attrs(
        _delivered_twice(b.staff, "staff_id", "salary_band", F.lit("~unknown")),
        ["role", "salary_band", "gender", "department"],
    )


@query
def distinct_staff_days(b: Base) -> DataFrame:
    return cleaning.distinct_staff_days(b.plain)


# --- staff -------------------------------------------------------------------


@query
def staff_hourly_rate(b: Base) -> DataFrame:
    millionths = F.lit(900_000) + F.col("staff_id") * 7919 % 200_001
    noise = millionths.cast("decimal(10,0)") * F.lit("0.000001").cast("decimal(7,6)")
    return stf.with_hourly_rate(b.staff, noise).select(
        "staff_id", "role", "experience_level", "per_hour_rate"
    )


@query
def salary_band(b: Base) -> DataFrame:
    return stf.with_salary_band(b.staff).select("staff_id", "per_hour_rate", "salary_band")


@query
def employment_type_split(b: Base) -> DataFrame:
    return stf.split_employment_type(b.staff).select(
        "staff_id", "employment_type", "employment_base", "employment_gender"
    )


@query
def surrogate_key(b: Base) -> DataFrame:
    return numbering.with_surrogate_key(b.plain.select(*SHIFT), "timesheet_key", "TS_", [ID])


@query
def staff_female_night_backfill(b: Base) -> DataFrame:
    return stf.backfill_female_night(b.staff, b.shifts).select(
        "staff_id", "gender", "night_shift_female_flag"
    )


@query
def active_staff(b: Base) -> DataFrame:
    return stf.active_staff(b.staff).select("staff_id", "status", "role", "department")


@query
def leave_eligible_staff(b: Base) -> DataFrame:
    return stf.leave_eligible_staff(b.staff).select("staff_id", "status", "role", "department")


@query
def shift_staff_lookup(b: Base) -> DataFrame:
    return stf.with_staff_attributes(b.all_shifts.select(*SHIFT), b.staff)


# --- shifts ------------------------------------------------------------------


@query
def surge_windows(b: Base) -> DataFrame:
    """The surge periods of the years in which shifts were worked."""
    years = b.lines.select(F.year("l_shipdate").alias("year")).distinct()
    return shf.surge_windows(years)


@query
def surge_flag(b: Base) -> DataFrame:
    return shf.with_surge_flag(b.plain).select(*SHIFT, "surge_period_flag")


@query
def shift_interval(b: Base) -> DataFrame:
    return shf.with_shift_interval(b.plain).select(
        ID, "shift_date", "shift_type", "shift_duration_hours", "shift_start", "shift_end"
    )


@query
def qa_shift_duration_rule(b: Base) -> DataFrame:
    return shf.qa_shift_duration_rule(b.shifts)


@query
def overtime_hours(b: Base) -> DataFrame:
    return shf.with_overtime(b.plain).select(ID, "shift_duration_hours", "overtime_hours")


@query
def night_flag(b: Base) -> DataFrame:
    return shf.with_night_flag(b.plain).select(ID, "shift_type", "night_flag")


@query
def female_night_flag(b: Base) -> DataFrame:
    return b.shifts.select(ID, "gender", "shift_type", "female_night_flag")


@query
def department_override(b: Base) -> DataFrame:
    return b.shifts.select(ID, "home_department", "cross_post_flag", "department_override")


@query
def overtime_multiplier(b: Base) -> DataFrame:
    return b.shifts.select(ID, "overtime_hours", "overtime_multiplier")


@query
def overtime_pay(b: Base) -> DataFrame:
    return b.shifts.select(
        ID, "staff_id", "overtime_hours", "per_hour_rate", "overtime_multiplier", "overtime_pay"
    )


@query
def consecutive_days(b: Base) -> DataFrame:
    return history.with_consecutive_days(b.plain.select(*SHIFT))


@query
def staff_streaks(b: Base) -> DataFrame:
    return history.staff_streaks(b.plain)


def _intervals(b: Base) -> DataFrame:
    return shf.with_shift_interval(b.plain).select(
        *SHIFT, "shift_start", "shift_end", "shift_duration_hours"
    )


@query
def back_to_back_12h(b: Base) -> DataFrame:
    return history.with_back_to_back(_intervals(b)).select(*SHIFT, "back_to_back_12h_flag")


@query
def shift_gap_hours(b: Base) -> DataFrame:
    return history.with_gap_hours(_intervals(b)).select(*SHIFT, "gap_hours")


@query
def night_to_day_flip(b: Base) -> DataFrame:
    return history.with_night_to_day_flip(b.plain.select(*SHIFT, "shift_type"))


@query
def timesheet_enriched(b: Base) -> DataFrame:
    b = b.stored()
    return b.timesheet


# --- assignments -------------------------------------------------------------


@query
def assignment_expand(b: Base) -> DataFrame:
    return asg.expand_assignments(
        b.shifts.select(*SHIFT, "department_override", "assignment_count")
    )


@query
def surge_emergency_flag(b: Base) -> DataFrame:
    return b.assignments.select(
        "assignment_id", "assignment_date", "case_type", "surge_emergency_flag"
    )


@query
def critical_cases(b: Base) -> DataFrame:
    return asg.critical_cases(b.assignments)


@query
def emergency_cases(b: Base) -> DataFrame:
    return asg.emergency_cases(b.assignments)


@query
def shift_case_counts(b: Base) -> DataFrame:
    counts = asg.day_case_counts(b.assignments)
    return asg.with_case_counts(b.plain.select(*SHIFT), counts)


@query
def case_mix(b: Base) -> DataFrame:
    return asg.case_mix(b.assignments)


@query
def assignments_per_shift(b: Base) -> DataFrame:
    return asg.assignments_per_shift(b.assignments)


# --- burnout -----------------------------------------------------------------


def _with_drivers(b: Base) -> DataFrame:
    """Shifts with the five drivers of the acute score."""
    counts = asg.day_case_counts(b.assignments)
    return history.with_consecutive_days(b.shifts, counts)


@query
def burnout_score(b: Base) -> DataFrame:
    return burnout.with_acute_score(_with_drivers(b)).select(
        ID, "overtime_hours", "critical_cases", "night_flag", "consecutive_days_flag",
        "emergency_cases", "acute_score",
    )


@query
def burnout_components(b: Base) -> DataFrame:
    scored = burnout.with_burnout_components(_with_drivers(b))
    return scored.select(ID, *[name for name in scored.columns if name.startswith("score_")])


@query
def burnout_risk_label(b: Base) -> DataFrame:
    scored = burnout.with_acute_score(_with_drivers(b))
    return burnout.with_risk_label(scored, "acute_score").select(
        ID, "acute_score", "burnout_risk_label"
    )


@query
def burnout_susceptibility(b: Base) -> DataFrame:
    return burnout.with_susceptibility(b.shifts).select(
        ID, "role", "home_department", "experience_level", "susceptibility"
    )


@query
def acute_load(b: Base) -> DataFrame:
    return burnout.with_acute_load(history.with_consecutive_days(b.shifts)).select(
        ID, "acute_load"
    )


@query
def chronic_prob(b: Base) -> DataFrame:
    return burnout.with_chronic_probability(history.with_consecutive_days(b.shifts)).select(
        ID, "chronic_prob"
    )


@query
def chronic_uplift(b: Base) -> DataFrame:
    b = b.stored()
    return b.scored.select(
        ID, "acute_score", "chronic_boost", "burnout_score", "burnout_risk_label"
    )


# --- leave -------------------------------------------------------------------


@query
def worked_days(b: Base) -> DataFrame:
    return b.worked


@query
def leave_window(b: Base) -> DataFrame:
    return leave.with_leave_window(b.requests, sample.WINDOW_END).select(
        "leave_id", "leave_start", "duration_days", "leave_end"
    )


@query
def leave_shift_conflicts(b: Base) -> DataFrame:
    requested = leave.with_leave_window(b.requests, sample.WINDOW_END)
    return leave.leave_shift_conflicts(requested, b.plain).select(
        "leave_id", "staff_id", "leave_start", "leave_end"
    )


@query
def leave_resolve_conflicts(b: Base) -> DataFrame:
    return b.moved.select("leave_id", "staff_id", "moved_days", "leave_start", "leave_end")


@query
def leave_days_count(b: Base) -> DataFrame:
    return b.leaves.select("leave_id", "leave_start", "leave_end", "leave_days_count")


@query
def leave_residual_conflicts(b: Base) -> DataFrame:
    """Leaves that still contain a worked day after they were moved."""
    in_window = b.plain.where(F.col("shift_date") <= F.lit(sample.WINDOW_END))
    return leave.leave_shift_conflicts(b.moved, in_window).select(
        "leave_id", "staff_id", "leave_start", "leave_end"
    )


# --- dimensions and facts ----------------------------------------------------


@query
def dim_date(b: Base) -> DataFrame:
    """The calendar of the years in which shifts were worked."""
    bounds = b.lines.agg(
        F.trunc(F.min("l_shipdate"), "year").alias("first_day"),
        F.last_day(F.add_months(F.trunc(F.max("l_shipdate"), "year"), 11)).alias("last_day"),
    )
    return dims.dim_date(bounds)


@query
def dim_department(b: Base) -> DataFrame:
    """All departments, with the shifts worked in each."""
    return dims.with_fact_count(
        dims.dim_department(b.spark), "department_name", b.shifts, "department_override", "shift_count"
    )


@query
def dim_shift_type(b: Base) -> DataFrame:
    """All shift types, with the shifts of each."""
    return dims.with_fact_count(
        dims.dim_shift_type(b.spark), "shift_type_name", b.plain, "shift_type", "shift_count"
    )


@query
def dim_staff(b: Base) -> DataFrame:
    return dims.dim_staff(b.staff)


@query
def iso_year_week(b: Base) -> DataFrame:
    return facts.with_year_week(b.plain).select(ID, "shift_date", "year_week")


@query
def fact_burnout(b: Base) -> DataFrame:
    b = b.stored()
    return facts.fact_burnout(b.timesheet, b.staff)


@query
def worst_risk(b: Base) -> DataFrame:
    b = b.stored()
    return facts.worst_risk(b.timesheet)


@query
def fact_overtime(b: Base) -> DataFrame:
    b = b.stored()
    return facts.fact_overtime(b.timesheet)


@query
def fact_leave(b: Base) -> DataFrame:
    return facts.fact_leave(b.leaves)


# --- quality -----------------------------------------------------------------


@query
def qa_table_summary(b: Base) -> DataFrame:
    b = b.stored()
    return quality.qa_table_summary(
        {
            "staff_master": b.staff,
            "staff_timesheet": b.timesheet,
            "patient_assignment": b.assignments.drop("timesheet_id"),
            "leave_records": b.leaves,
        }
    )


@query
def qa_home_shift_mismatch(b: Base) -> DataFrame:
    return quality.qa_home_shift_mismatch(b.shifts)


@query
def qa_shift_assignment_mismatch(b: Base) -> DataFrame:
    """Over assignments as delivered, whose department is their own."""
    return quality.qa_shift_assignment_mismatch(b.raw_assignments, b.shifts)


@query
def qa_argument_checks(b: Base) -> DataFrame:
    """Over the tables as delivered, before any filter or lookup."""
    return quality.qa_argument_checks(b.staff, b.all_shifts, b.raw_requests, b.raw_assignments)


@query
def qa_inactive_with_shifts(b: Base) -> DataFrame:
    """Over the shifts and leaves of all staff, before any filter."""
    return quality.qa_inactive_with_shifts(b.staff, b.all_shifts, b.raw_requests)
