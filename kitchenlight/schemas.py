"""Column lists of the raw extracts and of every produced table.

``name:TYPE`` with a trailing ``!`` for not-null. These names and types are fixed values: they are the
data contract with whoever reads the tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Headers of the raw extracts.
RAW_INSPECTION_HEADERS = (
    "SERIAL NUMBER",
    "ACTIVITY DATE",
    "FACILITY ZIP",
    "SCORE",
    "GRADE",
    "FACILITY ID",
    "FACILITY NAME",
    "FACILITY ADDRESS",
    "FACILITY CITY",
    "FACILITY STATE",
    "SERVICE CODE",
    "SERVICE DESCRIPTION",
    "PROGRAM NAME",
    "PROGRAM ELEMENT",
    "PE DESCRIPTION",
    "PROGRRAM STATUS",
    "OWNER ID",
    "OWNER NAME",
    "RECORD ID",
    "EMPLOYEE ID",
)
RAW_VIOLATION_HEADERS = (
    "SERIAL NUMBER",
    "VIOLATION STATUS",
    "VIOLATION CODE",
    "VIOLATION DESCRIPTION",
    "POINTS",
)

_HEALTH = """
    facility_key:VARCHAR! facility_name:VARCHAR facility_address:VARCHAR facility_city:VARCHAR
    facility_state:VARCHAR facility_zip5:VARCHAR! facility_id:VARCHAR owner_name:VARCHAR
    latest_activity_date:DATE latest_score:INTEGER latest_grade:VARCHAR inspections_12mo:BIGINT!
    inspections_24mo:BIGINT! bad_event_count:DOUBLE! violation_count:DOUBLE! total_points:DOUBLE!
    violations_per_inspection:DOUBLE! points_per_inspection:DOUBLE! score_trend:DOUBLE
    violation_score:DOUBLE event_score:DECIMAL cleanliness_index:DOUBLE! low_data_flag:BOOLEAN!
"""

_TABLES = {
    "stg_inspections": """
        serial_number:VARCHAR! activity_date:DATE! facility_zip5:VARCHAR! score:INTEGER grade:VARCHAR
        facility_id:VARCHAR facility_name:VARCHAR facility_address:VARCHAR facility_city:VARCHAR
        facility_state:VARCHAR service_code:VARCHAR service_description:VARCHAR program_name:VARCHAR
        program_element:VARCHAR pe_description:VARCHAR program_status:VARCHAR owner_id:VARCHAR
        owner_name:VARCHAR record_id:VARCHAR employee_id:VARCHAR
    """,
    "stg_violations": """
        serial_number:VARCHAR! violation_status:VARCHAR violation_code:VARCHAR
        violation_description:VARCHAR points:DOUBLE
    """,
    "dim_facility": """
        facility_key:VARCHAR! facility_name:VARCHAR facility_address:VARCHAR facility_city:VARCHAR
        facility_state:VARCHAR facility_zip5:VARCHAR! facility_id:VARCHAR owner_id:VARCHAR
        owner_name:VARCHAR service_code:VARCHAR service_description:VARCHAR program_name:VARCHAR
        first_seen_date:DATE last_seen_date:DATE inspection_count:BIGINT!
    """,
    "fct_inspection": """
        serial_number:VARCHAR! facility_key:VARCHAR! activity_date:DATE! score:INTEGER grade:VARCHAR
        facility_id:VARCHAR facility_name:VARCHAR facility_address:VARCHAR facility_city:VARCHAR
        facility_state:VARCHAR facility_zip5:VARCHAR service_code:VARCHAR service_description:VARCHAR
        program_name:VARCHAR program_element:VARCHAR pe_description:VARCHAR program_status:VARCHAR
        owner_id:VARCHAR owner_name:VARCHAR record_id:VARCHAR employee_id:VARCHAR
    """,
    "fct_violation": """
        violation_key:VARCHAR! serial_number:VARCHAR! facility_key:VARCHAR! violation_status:VARCHAR
        violation_code:VARCHAR violation_description:VARCHAR points:DOUBLE
    """,
    "mart_facility_health": _HEALTH,
    "mart_zip_health": """
        facility_zip5:VARCHAR! facility_count:BIGINT! avg_cleanliness_index:DOUBLE
        min_cleanliness_index:DOUBLE max_cleanliness_index:DOUBLE grade_a_pct:DOUBLE grade_b_pct:DOUBLE
        grade_c_pct:DOUBLE grade_null_pct:DOUBLE excellent_count:BIGINT! good_count:BIGINT!
        poor_count:BIGINT!
    """,
    "mart_repeat_offenders": _HEALTH.replace("facility_zip5:VARCHAR!", "facility_zip5:VARCHAR"),
    "dim_zip_geo": "zip:VARCHAR! lat:DOUBLE! lon:DOUBLE!",
    "mart_near_me": """
        facility_key:VARCHAR! facility_name:VARCHAR facility_address:VARCHAR facility_city:VARCHAR
        facility_zip5:VARCHAR cleanliness_index:DOUBLE! low_data_flag:BOOLEAN! zip_lat:DOUBLE!
        zip_lon:DOUBLE! home_zip:VARCHAR! distance_miles:DOUBLE! near_me_score:DOUBLE!
    """,
}

_TYPE_NAMES = {
    T.StringType: "VARCHAR",
    T.DateType: "DATE",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    T.TimestampNTZType: "TIMESTAMP",
}


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    not_null: bool


def contract_columns(table: str) -> list[ContractColumn]:
    """The contracted columns of a table, in order."""
    columns = []
    for item in _TABLES[table].split():
        name, kind = item.split(":")
        columns.append(ContractColumn(name, kind.rstrip("!"), kind.endswith("!")))
    return columns


def column_names(table: str) -> list[str]:
    return [column.name for column in contract_columns(table)]


def contract_tables() -> list[str]:
    return list(_TABLES)


def type_name(data_type: T.DataType) -> str:
    """Contract spelling of a Spark type."""
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    return _TYPE_NAMES.get(type(data_type), data_type.simpleString().upper())
