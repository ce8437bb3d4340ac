"""Declared columns of the base tables and conforming a table that was read to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _columns(text: str) -> T.StructType:
    """A schema from 'name type, name type'; needs no session, so it may run on import."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


STAFF_MASTER = _columns(
    "staff_id string, staff_name string, gender string, role string, experience_level string, "
    "department string, hire_date date, employment_type string, shift_preference string, "
    "status string, base_location string, per_hour_rate double, salary_band string, "
    "night_shift_female_flag long"
)
STAFF_TIMESHEET = _columns(
    "timesheet_id string, staff_id string, shift_date date, shift_start timestamp_ntz, "
    "shift_end timestamp_ntz, shift_type string, shift_duration_hours long, "
    "overtime_hours double, break_minutes long, department_override string, "
    "logged_hours_flag boolean, burnout_score long, burnout_risk_label string, "
    "surge_period_flag long, consecutive_days_flag long, back_to_back_12h_flag long, "
    "night_to_day_flip_flag long, female_night_flag long, overtime_multiplier double, "
    "overtime_pay double"
)
PATIENT_ASSIGNMENT = _columns(
    "assignment_id string, staff_id string, patient_id string, assignment_date date, "
    "severity_level long, department string, case_type string, "
    "assignment_duration_minutes long, critical_flag long, surge_emergency_flag long"
)
LEAVE_RECORDS = _columns(
    "leave_id string, staff_id string, leave_start date, leave_end date, leave_type string, "
    "leave_days_count long, approval_status string, emergency_leave_flag boolean"
)
TABLES = {
    "staff_master": STAFF_MASTER,
    "staff_timesheet": STAFF_TIMESHEET,
    "patient_assignment": PATIENT_ASSIGNMENT,
    "leave_records": LEAVE_RECORDS,
}
DIM_DATE = _columns(
    "date_key long, full_date date, day_of_week string, day_num int, week_number long, "
    "month_num int, month_name string, quarter int, year int, is_weekend long, "
    "is_surge_period long"
)


class SchemaError(ValueError):
    """A table lacks a declared column or holds it in a type that cannot become the declared one."""


def _from_nanoseconds(name: str) -> Column:
    """Nanoseconds since 1970, without a zone, as a timestamp of microseconds (rounded down)."""
    micros = F.expr(f"(`{name}` - pmod(`{name}`, 1000)) div 1000")
    return F.timestamp_micros(micros).cast("timestamp_ntz").alias(name)


def _conformed(df: DataFrame, field: T.StructField) -> Column:
    found, wanted = df.schema[field.name].dataType, field.dataType
    column = F.col(field.name)
    if found == wanted:
        return column
    if isinstance(wanted, T.TimestampNTZType) and isinstance(found, T.LongType):
        return _from_nanoseconds(field.name)
    numbers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
    cut = isinstance(found, T.DecimalType) and found.scale > 0 and isinstance(wanted, numbers)
    fractions = (T.FloatType, T.DoubleType)
    if isinstance(wanted, numbers) and isinstance(found, numbers) and not cut:
        return column.cast(wanted).alias(field.name)
    if isinstance(wanted, fractions) and isinstance(found, numbers + fractions):
        return column.cast(wanted).alias(field.name)
    if isinstance(wanted, T.StringType) and isinstance(found, numbers):
        return column.cast(wanted).alias(field.name)
    if isinstance(wanted, (T.DateType, T.TimestampNTZType)) and isinstance(
        found, (T.TimestampType, T.TimestampNTZType)
    ):
        return column.cast(wanted).alias(field.name)
    raise SchemaError(f"{field.name}: {found.simpleString()} cannot become {wanted.simpleString()}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their declared types, then any further columns as they are."""
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    declared = [_conformed(df, field) for field in schema]
    others = [name for name in df.columns if name not in schema.names]
    return df.select(*declared, *others)
