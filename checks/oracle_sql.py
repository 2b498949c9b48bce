"""The expected results of the registered queries, as SQL over the sample tables.

Each query names the common table expressions it needs; ``_with`` adds those they depend on.
"""

from __future__ import annotations

HOME = "91705"

# name -> (dependencies, body)
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    # ---- sample tables as inspections, violations and centroids ----
    "facility_row": (
        (),
        """
        SELECT c_custkey, c_name, c_mktsegment, n_name, (91700 + c_nationkey)::VARCHAR AS code
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        """,
    ),
    "scored_order": (
        (),
        """
        SELECT *,
            o_custkey - CASE WHEN o_custkey % 100 = 1 THEN 1 ELSE 0 END AS owner,
            100 - (o_orderkey * 7 + o_custkey * 3) % 31 AS raw_score
        FROM orders
        """,
    ),
    "insp": (
        ("facility_row", "scored_order"),
        """
        SELECT
            o_orderkey::VARCHAR AS serial_number,
            o_orderdate::DATE AS activity_date,
            code AS facility_zip5,
            CASE WHEN o_orderkey % 37 <> 0 THEN raw_score::INTEGER END AS score,
            CASE WHEN o_orderkey % 37 = 0 OR raw_score < 70 THEN NULL
                 WHEN raw_score < 80 THEN 'C' WHEN raw_score < 90 THEN 'B' ELSE 'A' END AS grade,
            o_custkey::VARCHAR AS facility_id,
            c_name AS facility_name,
            c_mktsegment AS facility_address,
            n_name AS facility_city,
            'CA' AS facility_state,
            left(o_orderpriority, 1) AS service_code,
            o_orderpriority AS service_description,
            CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS program_name,
            '1600' AS program_element,
            o_orderpriority AS pe_description,
            'ACTIVE' AS program_status,
            'OW' || owner AS owner_id,
            'Owner of ' || c_name AS owner_name,
            'PR' || o_orderkey AS record_id,
            'EE' || (o_orderkey % 50) AS employee_id,
            o_orderkey, raw_score
        FROM scored_order JOIN facility_row ON owner = c_custkey
        """,
    ),
    "keyed": (
        ("insp",),
        """
        SELECT *, sha256(concat_ws('|', lower(trim(facility_name)), lower(trim(facility_address)), facility_zip5,
                                   lower(trim(facility_city)))) AS facility_key
        FROM insp
        """,
    ),
    "viol": (
        (),
        """
        SELECT l_orderkey::VARCHAR AS serial_number, l_linestatus AS violation_status,
            l_returnflag || l_linenumber AS violation_code, p_type AS violation_description,
            CASE WHEN l_quantity < 10 THEN ((l_linenumber % 4) * 10 + l_partkey % 3)::DOUBLE / 10 ELSE 0 END AS points,
            l_orderkey, l_linenumber
        FROM lineitem JOIN part ON l_partkey = p_partkey
        """,
    ),
    "zip_geo": (
        (),
        """
        SELECT (91700 + n_nationkey)::VARCHAR AS zip, 34 + n_nationkey::DOUBLE / 100 AS lat,
            -118 + ((n_nationkey * 7) % 25)::DOUBLE / 50 AS lon
        FROM nation
        """,
    ),
    # ---- the same as dirty text ----
    "raw_insp": (
        ("insp",),
        """
        SELECT
            '  ' || serial_number || ' ' AS "SERIAL NUMBER",
            CASE WHEN o_orderkey % 501 = 0 THEN '13/45/2024'
                 WHEN o_orderkey % 2 = 0 THEN strftime(activity_date, '%-m/%-d/%Y')
                 ELSE strftime(activity_date, '%m/%d/%Y') END AS "ACTIVITY DATE",
            CASE WHEN o_orderkey % 401 = 0 THEN 'unknown'
                 WHEN o_orderkey % 3 = 0 THEN ' ' || facility_zip5 || '-1234 '
                 ELSE facility_zip5 END AS "FACILITY ZIP",
            CASE WHEN o_orderkey % 37 = 0 THEN ''
                 WHEN o_orderkey % 43 = 0 THEN 'N/A'
                 WHEN o_orderkey % 41 = 0 THEN raw_score || '.5'
                 ELSE ' ' || raw_score || ' ' END AS "SCORE",
            CASE WHEN o_orderkey % 37 = 0 THEN '  ' ELSE ' a ' END AS "GRADE",
            facility_id AS "FACILITY ID",
            facility_name || chr(160) AS "FACILITY NAME",
            facility_address AS "FACILITY ADDRESS",
            facility_city AS "FACILITY CITY",
            facility_state AS "FACILITY STATE",
            service_code AS "SERVICE CODE",
            service_description AS "SERVICE DESCRIPTION",
            program_name AS "PROGRAM NAME",
            program_element AS "PROGRAM ELEMENT",
            pe_description AS "PE DESCRIPTION",
            CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE ' Active ' END AS "PROGRRAM STATUS",
            owner_id AS "OWNER ID",
            owner_name AS "OWNER NAME",
            record_id AS "RECORD ID",
            employee_id AS "EMPLOYEE ID"
        FROM insp
        """,
    ),
    "raw_viol": (
        ("viol",),
        """
        SELECT
            CASE WHEN l_orderkey % 7 = 0 THEN serial_number ELSE '  ' || serial_number || ' ' END AS "SERIAL NUMBER",
            ' ' || lower(violation_status) AS "VIOLATION STATUS",
            CASE WHEN l_linenumber = 7 THEN '   ' ELSE violation_code END AS "VIOLATION CODE",
            chr(12288) || violation_description || ' ' AS "VIOLATION DESCRIPTION",
            CASE l_linenumber WHEN 6 THEN 'n/a' WHEN 5 THEN '1.5e0' WHEN 4 THEN ''
                 ELSE ' ' || (l_linenumber % 4) END AS "POINTS"
        FROM viol
        """,
    ),
    "area_zip": ((), "SELECT (91700 + n_nationkey)::VARCHAR AS zip FROM nation WHERE n_nationkey % 5 <> 4"),
    "kept": (
        ("raw_insp", "area_zip"),
        """
        SELECT r.*, z.zip AS facility_zip5
        FROM raw_insp r JOIN area_zip z ON z.zip = regexp_extract(r."FACILITY ZIP", '\\d{5}')
        """,
    ),
    "kept_viol": (
        ("raw_viol", "kept"),
        'SELECT * FROM raw_viol r WHERE EXISTS (FROM kept k WHERE k."SERIAL NUMBER" = r."SERIAL NUMBER")',
    ),
    "staged_insp": (
        ("raw_insp",),
        """
        SELECT trim("SERIAL NUMBER") AS serial_number,
            try_strptime(trim("ACTIVITY DATE"), '%m/%d/%Y')::DATE AS activity_date,
            regexp_extract("FACILITY ZIP", '\\d{5}') AS facility_zip5,
            TRY_CAST(trim("SCORE") AS INTEGER) AS score,
            CASE WHEN trim("GRADE") <> '' THEN upper(trim("GRADE")) END AS grade,
            "FACILITY ID" AS facility_id, trim("FACILITY NAME") AS facility_name,
            "FACILITY ADDRESS" AS facility_address, "FACILITY CITY" AS facility_city,
            "FACILITY STATE" AS facility_state, "SERVICE CODE" AS service_code,
            "SERVICE DESCRIPTION" AS service_description, "PROGRAM NAME" AS program_name,
            "PROGRAM ELEMENT" AS program_element, "PE DESCRIPTION" AS pe_description,
            CASE WHEN trim("PROGRRAM STATUS") <> '' THEN upper(trim("PROGRRAM STATUS")) END AS program_status,
            "OWNER ID" AS owner_id, "OWNER NAME" AS owner_name, "RECORD ID" AS record_id,
            "EMPLOYEE ID" AS employee_id
        FROM raw_insp
        """,
    ),
    "staged_viol": (
        ("raw_viol",),
        """
        SELECT trim("SERIAL NUMBER") AS serial_number, upper(trim("VIOLATION STATUS")) AS violation_status,
            CASE WHEN trim("VIOLATION CODE") <> '' THEN trim("VIOLATION CODE") END AS violation_code,
            trim("VIOLATION DESCRIPTION") AS violation_description, TRY_CAST(trim("POINTS") AS DOUBLE) AS points
        FROM raw_viol
        """,
    ),
    # ---- postal codes ----
    "seed_line": (
        (),
        """
        SELECT c_custkey, (c_custkey % 90000 + 10000)::VARCHAR AS code,
            CASE c_custkey % 7
                WHEN 1 THEN code || lpad((c_custkey % 9999)::VARCHAR, 4, '0')
                WHEN 2 THEN left(code, 3)
                ELSE code END AS digits
        FROM customer
        """,
    ),
    "postal_seed": (("seed_line",), "SELECT DISTINCT digits AS zip FROM seed_line WHERE length(digits) = 5"),
    "gazetteer": (
        ("postal_seed",),
        """
        SELECT (o_custkey % 90000 + 10000)::VARCHAR AS zip,
            CASE WHEN max(o_orderkey) % 8 = 0 THEN ''
                 ELSE printf('%.6f', 30 + (max(o_orderkey) % 1000)::DOUBLE / 100) END AS lat,
            printf('%.6f', -110 - (max(o_orderkey) % 997)::DOUBLE / 100) AS lon
        FROM orders
        WHERE o_custkey % 3 <> 0 AND (o_custkey % 90000 + 10000)::VARCHAR IN (FROM postal_seed)
        GROUP BY 1
        """,
    ),
    "postal_file": (
        ("postal_seed",),
        """
        SELECT (o_custkey % 90000 + 10000)::VARCHAR AS zip,
            printf('%.4f', 31 + (min(o_orderkey) % 800)::DOUBLE / 100) AS lat,
            printf('%.4f', -112 - (min(o_orderkey) % 700)::DOUBLE / 100) AS lon
        FROM orders
        WHERE o_custkey % 3 = 0 AND o_custkey % 9 <> 0 AND o_orderkey % 4 <> 0
          AND (o_custkey % 90000 + 10000)::VARCHAR IN (FROM postal_seed)
        GROUP BY 1
        """,
    ),
    "placed": (
        ("gazetteer", "postal_file"),
        """
        SELECT zip, lat, lon, 'primary' AS source FROM gazetteer
        UNION ALL
        SELECT zip, lat, lon, 'secondary' FROM postal_file WHERE zip NOT IN (SELECT zip FROM gazetteer)
        """,
    ),
    "rule": (
        ("placed", "postal_seed"),
        """
        SELECT c_custkey, (c_custkey % 90000 + 10000)::VARCHAR AS zip,
            CASE WHEN c_custkey % 7 = 0 THEN 'unsupported method' WHEN c_custkey % 11 = 0 THEN 'no neighbours' END AS fault
        FROM customer WHERE c_custkey % 18 = 0 AND zip IN (FROM postal_seed) AND zip NOT IN (SELECT zip FROM placed)
        """,
    ),
    "judged": (
        ("rule", "placed"),
        """
        SELECT r.zip, avg(TRY_CAST(p.lat AS DOUBLE)) AS lat, avg(TRY_CAST(p.lon AS DOUBLE)) AS lon,
            coalesce(any_value(fault), CASE
                WHEN count(p.zip) < 2 THEN 'neighbour without centroid'
                WHEN count(TRY_CAST(p.lat AS DOUBLE)) < 2 OR count(TRY_CAST(p.lon AS DOUBLE)) < 2
                THEN 'neighbour without coordinates' END) AS problem
        FROM rule r CROSS JOIN (VALUES (1), (2)) step(d)
        LEFT JOIN placed p ON p.zip = ((r.c_custkey + d) % 90000 + 10000)::VARCHAR
        GROUP BY r.zip
        """,
    ),
    "resolved": (
        ("placed", "judged", "postal_seed"),
        """
        SELECT s.zip, coalesce(p.lat, printf('%.6f', o.lat)) AS lat, coalesce(p.lon, printf('%.6f', o.lon)) AS lon,
            coalesce(p.source, CASE WHEN o.zip IS NOT NULL THEN 'override' END) AS source
        FROM postal_seed s
        LEFT JOIN placed p USING (zip)
        LEFT JOIN (FROM judged WHERE problem IS NULL) o USING (zip)
        """,
    ),
    # ---- warehouse and marts ----
    "dim": (
        ("keyed",),
        """
        SELECT facility_key, min(facility_name) AS facility_name, min(facility_address) AS facility_address,
            min(facility_city) AS facility_city, min(facility_state) AS facility_state,
            min(facility_zip5) AS facility_zip5, min(facility_id) AS facility_id, min(owner_id) AS owner_id,
            min(owner_name) AS owner_name, min(service_code) AS service_code,
            min(service_description) AS service_description, min(program_name) AS program_name,
            min(activity_date) AS first_seen_date, max(activity_date) AS last_seen_date, count(*) AS inspection_count
        FROM keyed GROUP BY facility_key
        """,
    ),
    "facts": (
        ("viol", "keyed"),
        """
        SELECT sha256(serial_number || '|' || ordinal) AS violation_key, serial_number, facility_key,
            violation_status, violation_code, violation_description, points
        FROM (SELECT v.*, row_number() OVER (PARTITION BY serial_number ORDER BY violation_code,
                  violation_description, points::VARCHAR, violation_status) AS ordinal FROM viol v)
        JOIN (SELECT serial_number, facility_key FROM keyed) USING (serial_number)
        """,
    ),
    "aged": (
        ("keyed",),
        "SELECT *, (SELECT max(activity_date) FROM keyed) - activity_date AS age FROM keyed",
    ),
    "visits": (
        ("aged",),
        """
        SELECT facility_key, min(facility_zip5) AS zip5,
            count(*) FILTER (age <= 365) AS n12,
            count(*) FILTER (age <= 730) AS n24,
            sum(score * weight) FILTER (age <= 365) / sum(weight) FILTER (age <= 365) AS trend,
            count(*) FILTER (age <= 365 AND score < 90) AS bad,
            max(activity_date) AS last_date,
            first(score ORDER BY activity_date DESC, score) FILTER (age <= 365 AND score IS NOT NULL) AS last_score,
            first(grade ORDER BY activity_date DESC, grade DESC)
                FILTER (age <= 365 AND grade IS NOT NULL) AS last_grade
        FROM (SELECT *, (CASE WHEN age <= 90 THEN 1 WHEN age <= 180 THEN 0.8 ELSE 0.6 END)::DECIMAL(2, 1) AS weight
              FROM aged)
        GROUP BY facility_key HAVING n12 > 0
        """,
    ),
    "penalties": (
        ("facts", "aged"),
        """
        SELECT f.facility_key, count(*)::DOUBLE AS n, sum(points::DECIMAL(18, 6))::DOUBLE AS points
        FROM facts f JOIN aged a USING (serial_number) WHERE age <= 365 GROUP BY f.facility_key
        """,
    ),
    "parts": (
        ("visits", "penalties"),
        """
        SELECT v.*, coalesce(p.n, 0) AS violation_count, coalesce(p.points, 0) AS total_points,
            coalesce(p.n, 0) / n12 AS per_visit, coalesce(p.points, 0) / n12 AS points_per_visit,
            least(100, greatest(0, 100 - 12 * per_visit - 8 * points_per_visit)) AS violation_score,
            least(100, greatest(0, 100 - 15 * bad))::DOUBLE AS event_score
        FROM visits v LEFT JOIN penalties p USING (facility_key)
        """,
    ),
    "health": (
        ("parts", "dim"),
        """
        SELECT facility_key, facility_name, facility_address, facility_city, facility_state, zip5 AS facility_zip5,
            facility_id, owner_name, last_date AS latest_activity_date, last_score AS latest_score,
            last_grade AS latest_grade, n12 AS inspections_12mo, n24 AS inspections_24mo,
            bad::DOUBLE AS bad_event_count, violation_count, total_points, per_visit AS violations_per_inspection,
            points_per_visit AS points_per_inspection, trend AS score_trend, violation_score, event_score,
            CASE WHEN trend IS NULL THEN 100.0::DOUBLE
                 ELSE least(100, greatest(0, 0.65 * trend + 0.25 * violation_score + 0.1 * event_score))
            END AS cleanliness_index,
            n12 < 2 AS low_data_flag
        FROM parts JOIN dim USING (facility_key)
        """,
    ),
    "home": (("zip_geo",), f"SELECT lat AS home_lat, lon AS home_lon FROM zip_geo WHERE zip = '{HOME}'"),
    "near": (
        ("health", "zip_geo", "home"),
        f"""
        SELECT facility_key, facility_name, facility_address, facility_city, facility_zip5, cleanliness_index,
            low_data_flag, lat AS zip_lat, lon AS zip_lon, '{HOME}' AS home_zip,
            3958.8 * 2 * asin(sqrt(pow(sin(radians((lat - home_lat) / 2)), 2)
                + cos(radians(home_lat)) * cos(radians(lat)) * pow(sin(radians((lon - home_lon) / 2)), 2)))
                AS distance_miles,
            cleanliness_index * (1 / (1 + distance_miles)) AS near_me_score,
            inspections_12mo
        FROM health JOIN zip_geo ON facility_zip5 = zip CROSS JOIN home
        """,
    ),
    "map_rows": (
        ("health", "zip_geo"),
        """
        SELECT facility_name, facility_city, facility_zip5, round(cleanliness_index, 2) AS cleanliness_index,
            facility_key, lat, lon
        FROM health JOIN zip_geo ON zip = facility_zip5
        WHERE inspections_12mo >= 2 AND NOT low_data_flag
        """,
    ),
    # ---- the written tables with faults, for the checks to find ----
    "faulty_dim": (
        ("dim",),
        """
        SELECT * REPLACE (CASE WHEN facility_zip5 <> '91702' THEN facility_key END AS facility_key) FROM dim
        UNION ALL FROM dim WHERE facility_zip5 = '91701'
        """,
    ),
    "faulty_insp": (("keyed",), "FROM keyed UNION ALL FROM keyed WHERE grade = 'C'"),
    "faulty_viol": (
        ("facts",),
        "SELECT * REPLACE (CASE WHEN points > 1 THEN 'x' ELSE '' END || serial_number AS serial_number) FROM facts",
    ),
    "faulty_stg": (
        ("insp",),
        """
        SELECT * REPLACE (
            CASE WHEN score = 75 THEN '' ELSE serial_number END AS serial_number,
            CASE WHEN score = 80 THEN NULL ELSE activity_date END AS activity_date,
            CASE WHEN score = 85 THEN left(facility_zip5, 4) ELSE facility_zip5 END AS facility_zip5)
        FROM insp
        """,
    ),
    "faulty_geo": (
        ("zip_geo",),
        """
        SELECT zip, CASE WHEN zip > '91720' THEN lat + 10 ELSE lat END AS lat,
            CASE WHEN zip <> '91702' THEN lon END AS lon
        FROM zip_geo
        """,
    ),
    "faulty_health": (
        ("health",),
        """
        SELECT * REPLACE (CASE WHEN facility_zip5 <> '91702' THEN facility_key END AS facility_key,
            CASE WHEN facility_zip5 <> '91703' THEN cleanliness_index * 1.5 - 40 END AS cleanliness_index)
        FROM health
        """,
    ),
    "faulty_near": (
        ("near",),
        """
        SELECT * REPLACE (CASE WHEN facility_zip5 <> '91702' THEN facility_key END AS facility_key,
            CASE facility_zip5 WHEN '91703' THEN -distance_miles WHEN '91706' THEN NULL ELSE distance_miles END
                AS distance_miles,
            near_me_score * 30 - 5 AS near_me_score)
        FROM near WHERE facility_zip5 <> '91704'
        """,
    ),
    "merge_counts": (
        ("keyed",),
        "SELECT count(DISTINCT facility_id) AS ids, count(DISTINCT facility_key) AS keys FROM keyed",
    ),
}

_SHOWN = """facility_name, facility_address, facility_city, facility_zip5, latest_grade, latest_score,
    round(cleanliness_index, 2) AS cleanliness_index, inspections_12mo, facility_key"""
_NEAR_SHOWN = """facility_name, facility_city, facility_zip5, round(near_me_score, 2) AS near_me_score,
    round(distance_miles, 1) AS distance_miles, facility_key, zip_lat AS lat, zip_lon AS lon"""
_USUAL = "inspections_12mo >= 2 AND NOT low_data_flag"
_REPORT = """ids AS distinct_facility_id, keys AS distinct_facility_key, ids - keys AS merged_facility_ids,
    round((ids - keys) / ids, 6) AS merge_rate"""


def _text_match(text: str) -> str:
    fields = " OR ".join(f"{name} ILIKE '%{text}%'" for name in ("facility_name", "facility_address", "facility_city"))
    return f"({fields} OR facility_zip5 = '{text}')"


def _closure(names: tuple[str, ...], seen: dict[str, None]) -> dict[str, None]:
    for name in names:
        if name not in seen:
            _closure(_PARTS[name][0], seen)
            seen[name] = None
    return seen


def _with(query: str, *names: str) -> str:
    ctes = ",\n".join(f"{name} AS ({_PARTS[name][1]})" for name in _closure(names, {}))
    return f"WITH {ctes}\n{query}" if ctes else query


def _checks(*rows: tuple[str, str, str]) -> str:
    """Check rows: table name, check name, and a query giving the count."""
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, ({count})::BIGINT AS failures"
        for table, check, count in rows
    )


def _duplicates(key: str, table: str) -> str:
    return f"SELECT count(*) - count(DISTINCT {key}) FROM {table}"


def _orphans(child: str, parent: str) -> str:
    return f"SELECT count(*) FROM {child} WHERE serial_number NOT IN (SELECT serial_number FROM {parent})"


def _parity(near: str, health: str) -> str:
    return f"SELECT abs((SELECT count(*) FROM {near}) - (SELECT count(*) FROM {health}))"


def _mart_audit(health: str) -> str:
    name = "mart_facility_health"
    bad_index = f"SELECT count(*) FROM {health} WHERE cleanliness_index IS NULL OR cleanliness_index NOT BETWEEN 0 AND 100"
    return _with(
        _checks(
            (name, "empty", f"SELECT (count(*) = 0)::INT FROM {health}"),
            (name, "facility_key missing", f"SELECT count(*) - count(facility_key) FROM {health}"),
            (name, "cleanliness_index missing or out of range", bad_index),
        ),
        health,
    )


def _near_me_audit(near: str, health: str) -> str:
    name = "mart_near_me"
    return _with(
        _checks(
            (name, "facility_key missing", f"SELECT count(*) - count(facility_key) FROM {near}"),
            (name, "distance_miles missing", f"SELECT count(*) - count(distance_miles) FROM {near}"),
            (name, "distance_miles negative", f"SELECT count(*) FROM {near} WHERE distance_miles < 0"),
            (name, "rows differ from mart_facility_health", _parity(near, health)),
        ),
        near,
        health,
    )


def _core_audit(dim: str, inspections: str, violations: str) -> str:
    return _with(
        _checks(
            ("dim_facility", "facility_key missing", f"SELECT count(*) - count(facility_key) FROM {dim}"),
            ("dim_facility", "facility_key duplicated", _duplicates("facility_key", dim)),
            ("fct_inspection", "serial_number duplicated", _duplicates("serial_number", inspections)),
            ("fct_violation", "orphan serial_number", _orphans(violations, inspections)),
        ),
        dim,
        inspections,
        violations,
    )


def _suite(dim: str, insp: str, viol: str, health: str, stg: str, geo: str, near: str) -> str:
    """The quality suite over the given tables."""

    def empty(name: str, table: str) -> tuple[str, str, str]:
        return (name, "empty", f"SELECT (count(*) = 0)::INT FROM {table}")

    def rows(table: str, condition: str) -> str:
        return f"SELECT count(*) FROM {table} WHERE {condition}"

    return _with(
        _checks(
            empty("dim_facility", dim),
            ("dim_facility", "facility_key duplicated", _duplicates("facility_key", dim)),
            empty("fct_inspection", insp),
            ("fct_inspection", "serial_number duplicated", _duplicates("serial_number", insp)),
            empty("fct_violation", viol),
            ("fct_violation", "orphan serial_number", _orphans(viol, insp)),
            empty("mart_facility_health", health),
            ("mart_facility_health", "cleanliness_index out of range", rows(health, "cleanliness_index NOT BETWEEN 0 AND 100")),
            ("mart_facility_health", "facility_key missing", f"SELECT count(*) - count(facility_key) FROM {health}"),
            ("stg_inspections", "serial_number missing", rows(stg, "coalesce(serial_number, '') = ''")),
            ("stg_inspections", "activity_date missing", f"SELECT count(*) - count(activity_date) FROM {stg}"),
            ("stg_inspections", "facility_zip5 not five digits", rows(stg, "coalesce(length(facility_zip5), 0) <> 5")),
            empty("dim_zip_geo", geo),
            ("dim_zip_geo", "coordinates out of range", rows(geo, "lat < 30 OR lat > 40 OR lon < -125 OR lon > -110")),
            empty("mart_near_me", near),
            ("mart_near_me", "distance_miles negative", rows(near, "distance_miles < 0")),
            ("mart_near_me", "near_me_score out of range", rows(near, "near_me_score NOT BETWEEN 0 AND 100")),
            ("mart_near_me", "near_me_score above cleanliness_index", rows(near, "near_me_score > cleanliness_index")),
            ("mart_near_me", "rows differ from mart_facility_health", _parity(near, health)),
        ),
        dim, insp, viol, health, stg, geo, near,
    )


def _contract_rows() -> str:
    """Every contracted column is sound in the produced tables."""
    from kitchenlight.schemas import column_names, contract_tables

    rows = ", ".join(f"('{table}', '{column}')" for table in contract_tables() for column in column_names(table))
    return f"SELECT table_name, column_name, '' AS problems, 0::BIGINT AS null_rows FROM (VALUES {rows}) c(table_name, column_name)"


_PROFILE = """h.facility_key, h.facility_name, h.facility_address, h.facility_city, facility_state, h.facility_zip5,
    owner_name, latest_activity_date, latest_score, latest_grade, h.cleanliness_index, h.inspections_12mo,
    h.low_data_flag"""
_STAGED_COLUMNS = """serial_number, activity_date, facility_zip5, score, grade, facility_id, facility_name,
    facility_address, facility_city, facility_state, service_code, service_description, program_name,
    program_element, pe_description, program_status, owner_id, owner_name, record_id, employee_id"""

_TOP_MERGED = _with(
    """
    SELECT facility_key, min(facility_name) AS facility_name, min(facility_address) AS facility_address,
        min(facility_zip5) AS facility_zip5, min(facility_city) AS facility_city,
        count(DISTINCT facility_id) AS facility_id_count
    FROM keyed GROUP BY 1 HAVING facility_id_count >= 2 ORDER BY facility_id_count DESC, facility_key LIMIT 10
    """,
    "keyed",
)

ORACLES: dict[str, str] = {
    "area_filter": _with("FROM kept", "kept"),
    "violation_semi_join": _with("FROM kept_viol", "kept_viol"),
    "zip_coverage": _with(
        """
        SELECT k.facility_zip5 AS zip, count(*) AS inspection_count, coalesce(sum(v.n), 0)::BIGINT AS violation_count
        FROM kept k LEFT JOIN (SELECT "SERIAL NUMBER", count(*) AS n FROM kept_viol GROUP BY ALL) v USING ("SERIAL NUMBER")
        GROUP BY 1
        """,
        "kept",
        "kept_viol",
    ),
    "seed_normalise": _with("SELECT DISTINCT left(digits, 5) AS zip FROM seed_line WHERE length(digits) >= 5", "seed_line"),
    "seed_exact": _with("FROM postal_seed", "postal_seed"),
    "tsv_gazetteer": _with("FROM gazetteer", "gazetteer"),
    "tsv_positional": _with("FROM postal_file", "postal_file"),
    "zip_centroids": _with("FROM resolved", "resolved"),
    "override_problems": _with("SELECT zip, problem FROM judged WHERE problem IS NOT NULL", "judged"),
    "centroid_counts": _with(
        """
        SELECT count(*) AS seed_zips, count(*) FILTER (source = 'primary') AS found_from_primary,
            count(*) FILTER (source = 'secondary') AS found_from_secondary,
            count(*) FILTER (source = 'override') AS found_from_overrides,
            count(*) FILTER (source IS NULL) AS still_missing
        FROM resolved
        """,
        "resolved",
    ),
    "dim_zip_geo": _with("FROM zip_geo", "zip_geo"),
    "roundtrip_csv": _with(
        """SELECT * REPLACE (nullif("SCORE", '') AS "SCORE") FROM raw_insp""",
        "raw_insp",
    ),
    "roundtrip_parquet": _with(f"SELECT {_STAGED_COLUMNS} FROM insp", "insp"),
    "landing_manifest": "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS row_count, 1::BIGINT AS file_count, true AS has_bytes FROM {name}"
        for name in ("orders", "lineitem", "customer", "part", "nation")
    ),
    "run_metadata": _with(
        f"""
        SELECT {_REPORT}, (SELECT count(*) FROM dim) AS dim_facility_rows,
            (SELECT count(*) FROM keyed) AS fct_inspection_rows, (SELECT count(*) FROM facts) AS fct_violation_rows
        FROM merge_counts
        """,
        "merge_counts",
        "dim",
        "facts",
    ),
    "metadata_read": _with(
        """
        SELECT strftime(max(latest_activity_date), '%b %d, %Y') AS last_updated,
            count(*) FILTER (cleanliness_index >= 90) AS excellent,
            count(*) FILTER (cleanliness_index >= 70 AND cleanliness_index < 90) AS good,
            count(*) FILTER (cleanliness_index < 70) AS poor, count(*) FILTER (low_data_flag) AS low_data
        FROM health
        """,
        "health",
    ),
    "stage_inspections": _with("FROM staged_insp", "staged_insp"),
    "stage_violations": _with("FROM staged_viol", "staged_viol"),
    "stage_audit": _with(
        _checks(
            ("stg_inspections", "empty", "0"),
            ("stg_inspections", "serial_number missing", "SELECT count(*) FROM staged_insp WHERE coalesce(serial_number, '') = ''"),
            ("stg_inspections", "activity_date missing", "SELECT count(*) - count(activity_date) FROM staged_insp"),
            ("stg_inspections", "facility_zip5 not five digits", "SELECT count(*) FROM staged_insp WHERE facility_zip5 = ''"),
            ("stg_inspections", "score missing", "SELECT count(*) - count(score) FROM staged_insp"),
            ("stg_inspections", "grade missing", "SELECT count(*) - count(grade) FROM staged_insp"),
            ("stg_inspections", "score out of range", "SELECT count(*) FROM staged_insp WHERE score > 100 OR score < 0"),
            ("stg_violations", "empty", "0"),
            ("stg_violations", "serial_number missing", "SELECT count(*) FROM staged_viol WHERE coalesce(serial_number, '') = ''"),
            ("stg_violations", "violation_code missing", "SELECT count(*) - count(violation_code) FROM staged_viol"),
            ("stg_violations", "points missing", "SELECT count(*) - count(points) FROM staged_viol"),
        ),
        "staged_insp",
        "staged_viol",
    ),
    "dim_facility": _with("FROM dim", "dim"),
    "fct_inspection": _with("SELECT * EXCLUDE (o_orderkey, raw_score) FROM keyed", "keyed"),
    "fct_violation": _with("FROM facts", "facts"),
    "orphan_violations": _with(
        """
        SELECT count(*) AS failures FROM viol v
        WHERE NOT EXISTS (FROM insp i JOIN area_zip ON zip = facility_zip5 WHERE i.serial_number = v.serial_number)
        """,
        "viol",
        "insp",
        "area_zip",
    ),
    "duplicate_keys": _with(
        _checks(
            ("dim_facility", "facility_key", "SELECT count(*) - count(DISTINCT facility_key) FROM dim"),
            ("fct_inspection", "serial_number", "SELECT count(*) - count(DISTINCT serial_number) FROM insp"),
            ("stg_violations", "serial_number", "SELECT count(*) - count(DISTINCT serial_number) FROM viol"),
        ),
        "dim",
        "viol",
    ),
    "merge_report": _with(f"SELECT {_REPORT} FROM merge_counts", "merge_counts"),
    "top_merged": _TOP_MERGED,
    "run_metadata_top": _TOP_MERGED,
    "facility_health": _with("FROM health", "health"),
    "zip_health": _with(
        """
        SELECT facility_zip5, count(*) AS facility_count,
            round(sum(cleanliness_index::DECIMAL(20, 10))::DOUBLE / count(cleanliness_index), 2) AS avg_cleanliness_index,
            round(min(cleanliness_index), 2) AS min_cleanliness_index,
            round(max(cleanliness_index), 2) AS max_cleanliness_index,
            round(100.0 * sum((latest_grade IS NOT DISTINCT FROM 'A')::INT) / count(*), 1)::DOUBLE AS grade_a_pct,
            round(100.0 * sum((latest_grade IS NOT DISTINCT FROM 'B')::INT) / count(*), 1)::DOUBLE AS grade_b_pct,
            round(100.0 * sum((latest_grade IS NOT DISTINCT FROM 'C')::INT) / count(*), 1)::DOUBLE AS grade_c_pct,
            round(100.0 * (count(*) - count(latest_grade)) / count(*), 1)::DOUBLE AS grade_null_pct,
            sum((cleanliness_index >= 90)::INT)::BIGINT AS excellent_count,
            sum((cleanliness_index >= 70 AND cleanliness_index < 90)::INT)::BIGINT AS good_count,
            sum((cleanliness_index < 70)::INT)::BIGINT AS poor_count
        FROM health GROUP BY facility_zip5
        """,
        "health",
    ),
    "repeat_offenders": _with("FROM health WHERE cleanliness_index < 70 OR bad_event_count > 1", "health"),
    "index_stats": _with(
        """
        SELECT round(min(cleanliness_index), 2) AS ci_min, round(quantile_cont(cleanliness_index, 0.5), 2) AS ci_p50,
            round(quantile_cont(cleanliness_index, 0.9), 2) AS ci_p90, round(max(cleanliness_index), 2) AS ci_max
        FROM health
        """,
        "health",
    ),
    "index_bands": _with(
        """
        SELECT count(*) FILTER (cleanliness_index >= 90) AS excellent,
            count(*) FILTER (cleanliness_index >= 70 AND cleanliness_index < 90) AS good,
            count(*) FILTER (cleanliness_index < 70) AS poor, count(*) FILTER (low_data_flag) AS low_data
        FROM health
        """,
        "health",
    ),
    "mart_audit": _mart_audit("health"),
    "near_me": _with("SELECT * EXCLUDE (inspections_12mo) FROM near", "near"),
    "near_me_top25": _with(
        """
        SELECT left(facility_name, 45) AS facility_name, left(facility_city, 15) AS facility_city, facility_zip5,
            round(distance_miles, 2) AS distance_miles, round(cleanliness_index, 4) AS cleanliness_index,
            round(near_me_score, 4) AS near_me_score
        FROM (FROM near ORDER BY near_me_score DESC NULLS LAST, facility_key LIMIT 25)
        """,
        "near",
    ),
    "dropped_zip_diagnostic": _with(
        """
        SELECT facility_zip5, count(*) AS facility_count FROM health ANTI JOIN area_zip ON zip = facility_zip5
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
        """,
        "health",
        "area_zip",
    ),
    "near_me_audit": _near_me_audit("near", "health"),
    "kpi_summary": _with(
        """
        SELECT count(*) AS n_facilities, round(median(cleanliness_index), 2) AS median_ci,
            round(100.0 * count(*) FILTER (low_data_flag) / count(*), 1)::DOUBLE AS pct_low_data,
            max(latest_activity_date) AS ref_date
        FROM health
        """,
        "health",
    ),
    "city_list": _with("SELECT DISTINCT facility_city FROM health", "health"),
    "zip_list": _with("SELECT DISTINCT facility_zip5 FROM health", "health"),
    "zip_known": _with(
        "SELECT DISTINCT facility_zip5, facility_zip5 IN (FROM area_zip) AS known FROM health", "health", "area_zip"
    ),
    "best_facilities": _with(
        f"SELECT {_SHOWN} FROM health h WHERE {_USUAL} ORDER BY h.cleanliness_index DESC, facility_key LIMIT 50", "health"
    ),
    "worst_facilities": _with(
        f"SELECT {_SHOWN} FROM health h ORDER BY h.cleanliness_index, facility_key LIMIT 50", "health"
    ),
    "search_facilities": _with(
        f"""SELECT {_SHOWN} FROM health h WHERE {_USUAL} AND {_text_match('customer#00000001')}
        ORDER BY h.cleanliness_index DESC NULLS LAST, facility_key LIMIT 500""",
        "health",
    ),
    "search_in_city": _with(
        f"""SELECT {_SHOWN} FROM health h
        WHERE facility_city = 'NATION_5' AND facility_zip5 = '91705' AND {_text_match('mach_ne')}
        ORDER BY h.cleanliness_index DESC NULLS LAST, facility_key LIMIT 500""",
        "health",
    ),
    "map_health": _with(
        "FROM map_rows WHERE facility_key IN (SELECT facility_key FROM health WHERE inspections_12mo >= 2 ORDER BY cleanliness_index, facility_key LIMIT 200)",
        "map_rows",
    ),
    "map_health_search": _with(
        f"""FROM map_rows WHERE facility_key IN (SELECT facility_key FROM health
        WHERE {_USUAL} AND {_text_match('nation_1')} ORDER BY cleanliness_index DESC, facility_key LIMIT 200)""",
        "map_rows",
    ),
    "map_near_me": _with(
        f"SELECT {_NEAR_SHOWN} FROM near n WHERE {_USUAL} ORDER BY n.near_me_score DESC, facility_key LIMIT 200", "near"
    ),
    "map_near_me_search": _with(
        f"""SELECT {_NEAR_SHOWN} FROM near n WHERE {_USUAL} AND {_text_match('91703')}
        ORDER BY n.near_me_score DESC NULLS LAST, facility_key LIMIT 200""",
        "near",
    ),
    "color_scale": _with(
        """
        SELECT facility_key, cleanliness_index, trunc(160 + (1 - level) * 95)::INTEGER AS red,
            trunc(30 + level * 100)::INTEGER AS green, trunc(30 + level * 60)::INTEGER AS blue, 210 AS alpha
        FROM (SELECT *, CASE WHEN max(cleanliness_index) OVER () > min(cleanliness_index) OVER ()
                  THEN (cleanliness_index - min(cleanliness_index) OVER ())
                       / (max(cleanliness_index) OVER () - min(cleanliness_index) OVER ()) ELSE 0.5 END AS level
              FROM map_rows WHERE facility_key IN (SELECT facility_key FROM health WHERE inspections_12mo >= 2
                                                   ORDER BY cleanliness_index, facility_key LIMIT 200))
        """,
        "map_rows",
    ),
    "map_center": _with(
        f"""
        SELECT 'home' AS center, round(home_lat, 9) AS lat, round(home_lon, 9) AS lon FROM home
        UNION ALL
        SELECT 'points', round(avg(zip_lat), 9), round(avg(zip_lon), 9)
        FROM (FROM near n WHERE {_USUAL} ORDER BY n.near_me_score DESC, facility_key LIMIT 200)
        WHERE facility_zip5 NOT LIKE '%4'
        """,
        "home",
        "near",
    ),
    "facility_profile": _with(
        """
        SELECT h.facility_key, h.facility_name, h.facility_address, h.facility_city, facility_state, h.facility_zip5,
            owner_name, latest_activity_date, latest_score, latest_grade, h.cleanliness_index, h.inspections_12mo,
            h.low_data_flag, near_me_score, distance_miles
        FROM health h LEFT JOIN near n USING (facility_key)
        """,
        "near",
    ),
    "profile_display": _with(
        """
        SELECT h.facility_key, coalesce(latest_grade, 'N/A') AS latest_grade, coalesce(latest_score, 0) AS latest_score,
            coalesce(near_me_score, 0) AS near_me_score
        FROM health h LEFT JOIN near n USING (facility_key)
        """,
        "near",
    ),
    "recent_inspections": _with(
        """
        SELECT facility_key, activity_date, score, grade, row_number() OVER latest AS rank_in_key
        FROM keyed
        WINDOW latest AS (PARTITION BY facility_key ORDER BY activity_date DESC, serial_number)
        QUALIFY rank_in_key <= 5
        """,
        "keyed",
    ),
    "top_violations": _with(
        """
        SELECT facility_key, violation_description, count(*) AS occurrences,
            sum(points::DECIMAL(18, 6))::DOUBLE AS total_points,
            row_number() OVER (PARTITION BY facility_key ORDER BY total_points DESC, violation_description) AS rank_in_key
        FROM facts GROUP BY 1, 2 QUALIFY rank_in_key <= 10
        """,
        "facts",
    ),
    "ranked_export": _with(
        f"""
        SELECT row_number() OVER (ORDER BY h.cleanliness_index DESC, facility_key) AS "#", facility_name AS "Facility",
            facility_address AS "Address", facility_city AS "City", facility_zip5 AS "ZIP", latest_grade AS "Grade",
            latest_score AS "Score", round(h.cleanliness_index, 2) AS "Cleanliness Index",
            inspections_12mo AS "Inspections (12mo)"
        FROM health h WHERE {_USUAL} ORDER BY 1 LIMIT 50
        """,
        "health",
    ),
    "contract_check": _contract_rows(),
    "contract_faults": _with(
        """
        SELECT 'stg_violations' AS table_name, 'serial_number' AS column_name, 'unexpected nulls' AS problems,
            (SELECT count(*) FROM viol WHERE points > 1) AS null_rows
        UNION ALL SELECT 'stg_violations', 'violation_status', '', 0
        UNION ALL SELECT 'stg_violations', 'violation_code', 'missing column', 0
        UNION ALL SELECT 'stg_violations', 'violation_description', '', 0
        UNION ALL SELECT 'stg_violations', 'points', 'wrong type', 0
        UNION ALL SELECT 'dim_zip_geo', unnest(['zip', 'lat', 'lon']), 'missing table', 0
        """,
        "viol",
    ),
    "quality_suite": _suite("dim", "insp", "facts", "health", "insp", "zip_geo", "near"),
    "quality_faults": _suite(
        "faulty_dim", "faulty_insp", "faulty_viol", "faulty_health", "faulty_stg", "faulty_geo", "faulty_near"
    ),
    "core_audit": _core_audit("dim", "insp", "viol"),
    "core_audit_faults": _core_audit("faulty_dim", "faulty_insp", "faulty_viol"),
    "mart_audit_faults": _mart_audit("faulty_health"),
    "near_me_faults": _near_me_audit("faulty_near", "health"),
    "color_modes": _with(
        """
        SELECT facility_key, mode,
            trunc(CASE mode WHEN 'BEST' THEN 30 + (1 - level) * 60 ELSE 20 END)::INTEGER AS red,
            trunc(CASE mode WHEN 'BEST' THEN 160 + level * 95 ELSE 100 + level * 80 END)::INTEGER AS green,
            trunc(CASE mode WHEN 'BEST' THEN 30 + (1 - level) * 60 ELSE 180 + level * 75 END)::INTEGER AS blue
        FROM (SELECT *, CASE WHEN max(cleanliness_index) OVER () > min(cleanliness_index) OVER ()
                  THEN (cleanliness_index - min(cleanliness_index) OVER ())
                       / (max(cleanliness_index) OVER () - min(cleanliness_index) OVER ()) ELSE 0.5 END AS level
              FROM map_rows WHERE facility_key IN (SELECT facility_key FROM health WHERE inspections_12mo >= 2
                                                   ORDER BY cleanliness_index, facility_key LIMIT 200))
        CROSS JOIN (VALUES ('BEST'), ('SEARCH')) modes(mode)
        """,
        "map_rows",
    ),
    "one_profile": _with(
        f"""
        SELECT {_PROFILE}, near_me_score, distance_miles FROM health h LEFT JOIN near n USING (facility_key)
        WHERE facility_key = (SELECT min(facility_key) FROM health)
        """,
        "near",
    ),
    "one_profile_without_near_me": _with(
        f"""
        SELECT {_PROFILE}, NULL::DOUBLE AS near_me_score, NULL::DOUBLE AS distance_miles FROM health h
        WHERE facility_key = (SELECT min(facility_key) FROM health)
        """,
        "health",
    ),
    "one_recent": _with(
        """
        SELECT facility_key, activity_date, score, grade FROM keyed
        WHERE facility_key = (SELECT min(facility_key) FROM health)
        ORDER BY activity_date DESC, serial_number LIMIT 5
        """,
        "health",
    ),
    "one_top_violations": _with(
        """
        SELECT facility_key, violation_description, count(*) AS occurrences,
            sum(points::DECIMAL(18, 6))::DOUBLE AS total_points
        FROM facts WHERE facility_key = (SELECT min(facility_key) FROM health)
        GROUP BY 1, 2 ORDER BY total_points DESC NULLS LAST, violation_description LIMIT 10
        """,
        "health",
        "facts",
    ),
    "staging_metadata": _with(
        """
        SELECT (SELECT count(*) FROM staged_insp) AS stg_inspections_rows,
            (SELECT count(*) FROM staged_viol) AS stg_violations_rows,
            (SELECT count(*) FROM staged_insp WHERE coalesce(serial_number, '') = '') AS inspection_serial_number,
            (SELECT count(*) - count(activity_date) FROM staged_insp) AS activity_date,
            (SELECT count(*) - count(score) FROM staged_insp) AS score,
            (SELECT count(*) - count(grade) FROM staged_insp) AS grade,
            (SELECT count(*) FROM staged_viol WHERE coalesce(serial_number, '') = '') AS violation_serial_number,
            (SELECT count(*) - count(violation_code) FROM staged_viol) AS violation_code,
            (SELECT count(*) - count(points) FROM staged_viol) AS points,
            (SELECT count(*) FROM staged_insp WHERE score > 100 OR score < 0) AS scores_outside_0_100
        """,
        "staged_insp",
        "staged_viol",
    ),
    "stat_gates": _with(
        """
        SELECT 'p90 above p50' AS gate, round(quantile_cont(cleanliness_index, 0.9), 6) AS value,
            round(quantile_cont(cleanliness_index, 0.5), 6) AS threshold,
            quantile_cont(cleanliness_index, 0.9) > quantile_cont(cleanliness_index, 0.5) AS passed FROM health
        UNION ALL
        SELECT 'share of perfect indexes', round(avg((cleanliness_index = 100)::INT), 6), 0.05::DOUBLE,
            avg((cleanliness_index = 100)::INT) <= 0.05 FROM health
        UNION ALL
        SELECT 'merge rate', round((ids - keys) / ids, 6), 0.05::DOUBLE, (ids - keys) / ids < 0.05 FROM merge_counts
        """,
        "health",
        "merge_counts",
    ),
}


def _numbered(name: str, order: str, shown: str) -> str:
    """The rows of another query's SQL with their place in its order."""
    return f"SELECT row_number() OVER (ORDER BY {order}) AS position, {shown} FROM ({ORACLES[name]})"


def _lacking(name: str, *needed: str) -> str:
    """The needed columns that a table has not, read from its own header."""
    return f"""
        SELECT '{name}' AS source, (SELECT count(*) FROM {name}) AS row_count, column_name
        FROM (SELECT unnest({list(needed)}) AS column_name)
        WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE {name}))
        """


ORACLES |= {
    "dim_zip_geo_lines": _numbered("dim_zip_geo", "zip", "zip"),
    "zip_health_order": _numbered(
        "zip_health", "avg_cleanliness_index DESC NULLS LAST, facility_zip5 NULLS LAST", "facility_zip5"
    ),
    "repeat_offenders_order": _numbered(
        "repeat_offenders", "cleanliness_index NULLS LAST, facility_key NULLS LAST", "facility_key"
    ),
    "city_list_order": _numbered("city_list", "facility_city", "facility_city"),
    "roundtrip_breaks": _with(
        """SELECT * REPLACE (nullif("SCORE", '') AS "SCORE", CASE WHEN "SERIAL NUMBER" LIKE '%7'
            THEN concat("FACILITY NAME", chr(10), '"', "SERIAL NUMBER", '",', chr(10)) ELSE "FACILITY NAME" END AS "FACILITY NAME")
        FROM raw_insp""",
        "raw_insp",
    ),
    "order_descents": """
        SELECT count(*) FILTER (prior_order > o_orderkey) AS by_order, count(*) FILTER (prior_customer > o_custkey) AS by_customer
        FROM (SELECT *, lag(o_orderkey) OVER w AS prior_order, lag(o_custkey) OVER w AS prior_customer
            FROM orders WINDOW w AS (ORDER BY o_orderkey))
        """,
    "required_columns": "UNION ALL".join(
        [
            _lacking("orders", "o_orderkey", "o_orderdate", "o_score", "o_grade"),
            _lacking("lineitem", "l_orderkey", "l_points"),
            _lacking("nation", "n_nationkey", "n_name"),
        ]
    ),
}
