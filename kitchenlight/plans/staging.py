"""Typed staging tables from the all-text extracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitchenlight.functions import blank_to_null, clean, clean_upper, parse_us_date, safe_double, safe_int, zip5
from kitchenlight.operators.audits import count_checks, union_checks

# Spellings of the status header found in the extracts, preferred one first.
STATUS_HEADERS = ("PROGRRAM STATUS", "PROGRAM STATUS")

# Staged column to raw header, for columns that are only cleaned.
_PLAIN_TEXT = {
    "facility_id": "FACILITY ID",
    "facility_name": "FACILITY NAME",
    "facility_address": "FACILITY ADDRESS",
    "facility_city": "FACILITY CITY",
    "facility_state": "FACILITY STATE",
    "service_code": "SERVICE CODE",
    "service_description": "SERVICE DESCRIPTION",
    "program_name": "PROGRAM NAME",
    "program_element": "PROGRAM ELEMENT",
    "pe_description": "PE DESCRIPTION",
    "owner_id": "OWNER ID",
    "owner_name": "OWNER NAME",
    "record_id": "RECORD ID",
    "employee_id": "EMPLOYEE ID",
}


def pick_column(df: DataFrame, *candidates: str) -> Column:
    """The first candidate the frame has, else a NULL text column."""
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("string")


def stage_inspections(raw: DataFrame) -> DataFrame:
    """Twenty typed columns, in contract order."""
    typed = {
        "serial_number": clean(F.col("SERIAL NUMBER")),
        "activity_date": parse_us_date(clean(F.col("ACTIVITY DATE"))),
        "facility_zip5": zip5(F.col("FACILITY ZIP")),
        "score": safe_int(clean(F.col("SCORE"))),
        "grade": clean_upper(F.col("GRADE")),
    }
    texts = {name: blank_to_null(F.col(header)) for name, header in _PLAIN_TEXT.items()}
    status = {"program_status": clean_upper(pick_column(raw, *STATUS_HEADERS))}
    order = [*typed, *list(texts)[:10], "program_status", *list(texts)[10:]]
    columns = typed | texts | status
    return raw.select(*[columns[name].alias(name) for name in order])


def stage_violations(raw: DataFrame) -> DataFrame:
    """Five typed columns."""
    return raw.select(
        clean(F.col("SERIAL NUMBER")).alias("serial_number"),
        clean_upper(F.col("VIOLATION STATUS")).alias("violation_status"),
        blank_to_null(F.col("VIOLATION CODE")).alias("violation_code"),
        blank_to_null(F.col("VIOLATION DESCRIPTION")).alias("violation_description"),
        safe_double(clean(F.col("POINTS"))).alias("points"),
    )


def _blank_serials() -> Column:
    return F.count_if(F.col("serial_number").isNull() | (F.col("serial_number") == ""))


def _no_rows() -> Column:
    return (F.count(F.lit(1)) == 0).cast("int")


def inspection_checks() -> dict[str, Column]:
    """The counts of staged inspections, by check."""
    score = F.col("score")
    return {
        "empty": _no_rows(),
        "serial_number missing": _blank_serials(),
        "activity_date missing": F.count_if(F.col("activity_date").isNull()),
        "facility_zip5 not five digits": F.count_if(F.col("facility_zip5").isNull() | (F.length("facility_zip5") != 5)),
        "score missing": F.count_if(score.isNull()),
        "grade missing": F.count_if(F.col("grade").isNull()),
        "score out of range": F.count_if(~score.between(0, 100)),
    }


def violation_checks() -> dict[str, Column]:
    """The counts of staged violations, by check."""
    return {
        "empty": _no_rows(),
        "serial_number missing": _blank_serials(),
        "violation_code missing": F.count_if(F.col("violation_code").isNull()),
        "points missing": F.count_if(F.col("points").isNull()),
    }


def stage_audit(inspections: DataFrame, violations: DataFrame) -> DataFrame:
    """Every staging count, one pass per table: ``(table_name, check_name, failures)``."""
    return union_checks(
        count_checks(inspections, "stg_inspections", inspection_checks()),
        count_checks(violations, "stg_violations", violation_checks()),
    )


# The counts that only inform; all others stop the run.
STAGE_INFO = ("score missing", "grade missing", "score out of range", "violation_code missing", "points missing")


def hard_stage_checks(audit: DataFrame) -> DataFrame:
    return audit.filter(~F.col("check_name").isin(*STAGE_INFO))


def hard_counts(counts: Mapping[str, int]) -> dict[str, int]:
    return {name: count for name, count in counts.items() if name not in STAGE_INFO}
