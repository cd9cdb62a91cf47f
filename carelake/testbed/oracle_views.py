"""The clinical tables as DuckDB views over the star schema, written independently of the flatteners.

`with_views` puts the views a query names, and those they need, in front of it.
"""

from __future__ import annotations

import re

ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


def _joined(lines: dict[str, str]) -> str:
    """Text of an adjudication list, in the form the query wrapper prints it."""
    return " || '|' || ".join(f"'{name}=' || {cents}" for name, cents in lines.items())


ADJUDICATION = {
    "Line Beneficiary Coinsurance Amount": "(cents//10*i)//5",
    "Line Provider Payment Amount": "(cents//10*i)*4//5",
    "Line Submitted Charge Amount": "cents//10*i",
    "Line Allowed Charge Amount": "cents//10*i",
    "Line Beneficiary Part B Deductible Amount": "0",
    "Line Processing Indicator Code": "NULL",
}
ADJUDICATION_TEXT = _joined(
    {n: ("'none'" if c == "NULL" else f"CAST({c} AS VARCHAR)") for n, c in ADJUDICATION.items()}
)
ADJUDICATION_ROWS = " UNION ALL ".join(
    f"SELECT eob_id, patient_reference, CAST({c} AS BIGINT) AS value_cents,"
    f" {'NULL' if c == 'NULL' else chr(39) + 'CAD' + chr(39)} AS currency,"
    f" '{n.lower()}' AS category_code, '{n}' AS category_display FROM eob WHERE has_lines"
    for n, c in ADJUDICATION.items()
)

VIEWS = {
    "n3": "SELECT * FROM (VALUES (1), (2), (3)) v(i)",
    "o": f"""SELECT *,
        CASE WHEN o_orderkey % 61 = 5 THEN NULL ELSE {ISO.format('o_orderdate')} END AS start_iso,
        CASE WHEN o_orderkey % 25 = 6 THEN NULL ELSE
          {ISO.format('o_orderdate + to_minutes(15 + (o_orderkey * 7919) % 100000)')} END AS end_iso,
        CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
        'urn:uuid:p' || o_custkey AS subject_ref, 'urn:uuid:e' || o_orderkey AS encounter_ref
      FROM orders""",
    "ln": f"""SELECT lineitem.*, p_name, p_type, p_size, o_custkey,
        {ISO.format('l_shipdate')} AS ship_iso,
        'urn:uuid:p' || o_custkey AS subject_ref, 'urn:uuid:e' || l_orderkey AS encounter_ref,
        l_orderkey || '-' || l_linenumber || '-' || l_partkey AS line_key
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "ev": f"""SELECT *, {ISO.format('ts')} AS ts_iso, 'urn:uuid:p' || user_id AS subject_ref,
        'urn:uuid:e' || event_id AS encounter_ref FROM events""",
    "patient": """SELECT 'p' || c_custkey AS patient_id,
        CASE WHEN c_custkey % 3 = 0 THEN 'Medical Record Number|Social Number'
             ELSE 'Medical Record Number' END AS identifier_types,
        c_name AS name,
        CASE WHEN c_custkey % 50 = 7 THEN NULL WHEN c_custkey % 2 = 0 THEN 'male'
             ELSE 'female' END AS gender,
        (1930 + (c_custkey * 37) % 90) || '-' || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0')
          || '-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') AS birth_date,
        n_name AS city, CASE WHEN c_nationkey % 5 = 0 THEN 'CA' ELSE r_name END AS state,
        'CA' AS country, lpad(CAST(c_custkey % 1000 AS VARCHAR), 4, '0') AS postal_code,
        CASE WHEN c_custkey % 7 <> 0 THEN 40 + c_nationkey / 2.0 END AS latitude,
        CASE WHEN c_custkey % 7 <> 0 THEN CAST(-(c_custkey % 180) AS DOUBLE) END AS longitude,
        '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
        CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN ' S' WHEN 2 THEN 'Never Married' END
          AS marital_status,
        'Maiden' || (c_custkey % 100) AS mothers_maiden_name,
        r_name AS birthplace_city, n_name AS birthplace_state, 'CA' AS birthplace_country,
        c_acctbal AS disability_adjusted_life_years, c_acctbal / 2 AS quality_adjusted_life_years,
        c_custkey % 11 = 0 AS multiple_birth,
        CASE WHEN c_nationkey % 2 = 0 THEN 'English|French' ELSE 'English' END AS languages
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "encounter": """SELECT 'e' || o_orderkey AS encounter_id,
        CASE WHEN o_orderstatus = 'O' THEN 'in-progress' ELSE 'finished' END AS status,
        CASE o_orderkey % 4 WHEN 0 THEN 'AMB' WHEN 1 THEN 'EMER' WHEN 2 THEN 'IMP' ELSE 'HH' END
          AS class_code,
        o_orderpriority AS type_text, start_iso AS start_time, end_iso AS end_time,
        subject_ref AS patient_reference,
        'Organization?identifier=' || (o_orderkey % 37) AS service_provider_id,
        CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'Clinic ' || (o_orderkey % 37) END
          AS service_provider_display,
        'Dr ' || (o_orderkey % 89 + i) AS participant_individual_display,
        'Practitioner?identifier=us-npi|' || (o_orderkey % 89 + i) AS participant_individual_reference,
        start_iso AS participant_period_start, end_iso AS participant_period_end,
        'PPRF' AS participant_type_code, 'primary performer' AS participant_type_display
      FROM o JOIN n3 ON i <= (o_orderkey // 4) % 4""",
    "condition": """SELECT 'd' || line_key AS condition_id,
        CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'resolved' END AS clinical_status,
        'confirmed' AS verification_status,
        CASE p_size % 10 WHEN 0 THEN 'Chronic ' || p_name WHEN 5 THEN 'old chronic ' || p_name
             ELSE p_name END AS condition_code_display,
        subject_ref AS patient_reference, encounter_ref AS encounter_reference,
        ship_iso AS onset_datetime,
        CASE WHEN l_linestatus = 'O' THEN NULL ELSE ship_iso END AS abatement_datetime,
        ship_iso AS recorded_date FROM ln""",
    "medication_request": """SELECT 'm' || line_key AS medication_request_id,
        CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'stopped' END AS status, 'order' AS intent,
        p_name AS medication_display, subject_ref AS patient_reference,
        'Practitioner?identifier=us-npi|' || l_suppkey AS requester_reference,
        'Dr ' || l_suppkey AS requester_display, encounter_ref AS encounter_reference,
        ship_iso AS authored_on, 'Take ' || i || ' daily' AS dosage_text
      FROM ln JOIN n3 ON i <= l_linenumber % 3""",
    "claim": """SELECT 'c' || o_orderkey AS claim_id, 'active' AS status,
        CASE WHEN o_orderkey % 2 = 0 THEN 'institutional' ELSE 'pharmacy' END AS type_code,
        'claim' AS use, subject_ref AS patient_reference, 'Patient ' || o_custkey AS patient_display,
        end_iso AS created_date, start_iso AS billable_period_start, end_iso AS billable_period_end,
        'Organization?identifier=' || (o_orderkey % 37) AS provider_reference, 'normal' AS priority,
        's' || s.i AS supporting_info_code,
        'urn:uuid:v' || o_orderkey || '-' || s.i AS supporting_info_value_reference,
        o_orderpriority AS insurance_coverage_display, TRUE AS insurance_focal,
        o_totalprice AS total_amount, 'CAD' AS currency,
        'urn:uuid:d' || o_orderkey || '-' || d.i AS diagnosis_reference,
        'i' || ((o_orderkey + t.i) % 500) AS item_code,
        'Item ' || ((o_orderkey + t.i) % 500) AS item_description,
        'Category ' || t.i AS item_category,
        (o_orderkey % 1000) * t.i / 4.0 AS item_net_value, 'CAD' AS item_net_currency,
        encounter_ref AS encounter_reference,
        CASE WHEN o_orderkey % 2 = 0 THEN 'Ward' ELSE 'Office' END AS location_description,
        start_iso AS service_period_start, end_iso AS service_period_end,
        CAST(NULL AS VARCHAR) AS adjudication
      FROM o JOIN n3 s ON s.i <= o_orderkey % 3 JOIN n3 d ON d.i <= (o_orderkey // 3) % 3
             JOIN n3 t ON t.i <= 1 + (o_orderkey // 9) % 3""",
    "eob": f"""SELECT 'b' || o_orderkey AS eob_id, 'c' || o_orderkey AS identifier_claim_id,
        'g' || o_custkey AS identifier_claim_group, 'active' AS status,
        CASE WHEN o_orderkey % 2 = 0 THEN 'institutional' ELSE 'pharmacy' END AS code,
        'claim' AS use, subject_ref AS patient_reference,
        start_iso AS billable_period_start, end_iso AS billable_period_end,
        o_orderpriority AS insurer_display,
        'Organization?identifier=' || (o_orderkey % 37) AS provider_reference,
        '#referral' AS referral_reference, 'urn:uuid:c' || o_orderkey AS claim_reference,
        'complete' AS outcome,
        'Practitioner?identifier=us-npi|' || (o_orderkey % 89 + t) AS care_team_provider_reference,
        'Primary provider' AS care_team_role, '#coverage' AS insurance_coverage_reference,
        o_orderpriority AS insurance_coverage_display, TRUE AS insurance_focal,
        'Category ' || i AS item_category_display, 'i' || ((o_orderkey + i) % 500) AS item_service_code,
        'Item ' || ((o_orderkey + i) % 500) AS item_service_description,
        (cents // 10 * i) / 100.0 AS item_net_value, 'CAD' AS item_net_currency,
        CASE WHEN o_orderkey % 2 = 0 THEN 'Ward' ELSE 'Office' END AS location_description,
        start_iso AS service_period_start, end_iso AS service_period_end,
        CASE WHEN NOT (i = 1 AND o_orderkey % 5 = 0) THEN {ADJUDICATION_TEXT} END AS adjudication,
        o_totalprice AS total_amount, 'CAD' AS total_currency,
        (cents * 4 // 5) / 100.0 AS payment_amount, 'CAD' AS payment_currency, end_iso AS created_date,
        NOT (i = 1 AND o_orderkey % 5 = 0) AS has_lines, cents, i
      FROM (SELECT o.*, n3.i, t.i AS t, k.i AS k FROM o
            JOIN n3 ON n3.i <= 1 + (o_orderkey // 4) % 3
            JOIN n3 t ON t.i <= 1 + o_orderkey % 2
            JOIN n3 k ON k.i <= 1 + (o_orderkey // 2) % 2)""",
    "adj": ADJUDICATION_ROWS,
    "careplan": """SELECT 'n' || o_orderkey AS careplan_id,
        CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'completed' END AS status,
        'order' AS intent, subject_ref AS patient_reference, encounter_ref AS encounter_reference,
        start_iso AS period_start, end_iso AS period_end, CAST(NULL AS VARCHAR) AS created_date,
        'urn:uuid:t' || o_orderkey || '-' || t.i AS care_team_reference,
        'Activity ' || a.i AS activity_display, 'a' || a.i AS activity_code,
        CASE WHEN o_orderstatus = 'O' THEN 'in-progress' ELSE 'completed' END AS activity_status,
        'Clinic ' || (o_orderkey % 37) AS activity_location,
        'urn:uuid:d' || o_orderkey || '-1' || CASE WHEN (o_orderkey // 6) % 2 = 1
          THEN '|urn:uuid:d' || o_orderkey || '-2' ELSE '' END AS addresses,
        'Plan ' || o_orderpriority AS category_text
      FROM o JOIN n3 t ON t.i <= 1 + o_orderkey % 2 JOIN n3 a ON a.i <= (o_orderkey // 2) % 3""",
    "careteam": """SELECT 't' || o_orderkey AS care_team_id,
        CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'inactive' END AS status,
        subject_ref AS subject_reference, encounter_ref AS encounter_reference,
        start_iso AS period_start, end_iso AS period_end,
        'Clinic ' || (o_orderkey % 37) AS managing_organization, 'Role ' || i AS participant_role,
        'Practitioner?identifier=us-npi|' || (o_orderkey % 89 + i) AS participant_reference,
        'Dr ' || (o_orderkey % 89 + i) AS participant_display
      FROM o JOIN n3 ON i <= 1 + o_orderkey % 3 WHERE o_orderkey % 5 <> 0""",
    "procedure": """SELECT 'r' || line_key AS procedure_id, 'completed' AS status,
        p_type || ' ' || p_size AS procedure_code_display, 't' || p_size AS procedure_code,
        subject_ref AS subject_reference, ship_iso AS performed_period_start,
        ship_iso AS performed_period_end, encounter_ref AS encounter_reference,
        'urn:uuid:d' || line_key || '-' || i AS reason_reference,
        p_name || ' ' || i AS reason_reference_display
      FROM ln JOIN n3 ON i <= 1 + l_linenumber % 2 WHERE l_returnflag <> 'N'""",
    "diagnostic_report": """SELECT 'g' || event_id AS diagnostic_report_id, 'final' AS status,
        'Panel ' || (event_id % 7) AS code, 'g' || (event_id % 7) AS code_system,
        subject_ref AS subject_reference, encounter_ref AS encounter_reference,
        ts_iso AS effective_date_time, ts_iso AS issued_date, 'Result ' || i AS result_display,
        upper(event_type) AS category_display
      FROM ev JOIN n3 ON i <= event_id % 4 WHERE event_type IN ('purchase', 'error')""",
    "immunization": """SELECT 'u' || event_id AS immunization_id, 'completed' AS status,
        'Vaccine ' || (event_id % 9) AS vaccine_display, 'v' || (event_id % 9) AS vaccine_code,
        subject_ref AS patient_reference, encounter_ref AS encounter_reference,
        event_id % 3 > 0 AS primary_source, ts_iso AS occurrence_date_time
      FROM ev WHERE event_type = 'signup'""",
    "observation": """SELECT 'o' || event_id AS observation_id, 'final' AS status,
        'Measure ' || (event_id % 13) AS observation_code_display,
        'o' || (event_id % 13) AS observation_code,
        subject_ref AS subject_reference, encounter_ref AS encounter_reference,
        ts_iso AS effective_date_time, ts_iso AS issued_date, value AS value_quantity_value,
        'mg' AS value_quantity_unit, upper(event_type) AS category_display
      FROM ev WHERE event_type IN ('view', 'click')""",
    "flat_csv": """SELECT 'e' || l_orderkey AS "ENCOUNTER_ID",
        CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS "GENDER", n_name AS "RACE",
        r_name AS "ETHNICITY",
        CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'S' END AS "MARITAL",
        make_date(1930 + (c_custkey * 37) % 90, 1 + c_custkey % 12, 1 + c_custkey % 28) AS "BIRTHDATE",
        o_orderpriority AS "ENCOUNTER_DESCRIPTION",
        CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE p_name END AS "ENCOUNTER_REASON_DESCRIPTION",
        p_type || ' ' || p_size AS "PROCEDURE_DESCRIPTION",
        l_extendedprice AS "ENCOUNTER_BASE_COST", o_totalprice AS "ENCOUNTER_TOTAL_CLAIM_COST",
        (CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) // 100)
          / 100.0 AS "ENCOUNTER_PAYER_COVERAGE",
        p_retailprice AS "PROCEDURE_BASE_COST"
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    # Cleaned tables of the disparity reports.
    "pat": """SELECT patient_id, gender, birth_date, state, postal_code,
        CASE lower(trim(marital_status)) WHEN 'm' THEN 'Married' WHEN 's' THEN 'Single'
          WHEN 'never married' THEN 'Never Married' ELSE 'Unknown' END AS marital_status,
        disability_adjusted_life_years, quality_adjusted_life_years,
        2024 - CAST(substr(birth_date, 1, 4) AS BIGINT) AS age FROM patient""",
    "enc": """SELECT encounter_id, CASE WHEN status = 'finished' THEN 'Completed' ELSE 'In-Progress' END
          AS status,
        CASE class_code WHEN 'IMP' THEN 'Inpatient' WHEN 'AMB' THEN 'Ambulatory'
          WHEN 'EMER' THEN 'Emergency' ELSE 'Unknown' END AS class_code,
        type_text, CAST(substr(start_time, 1, 19) AS TIMESTAMP) AS start_time,
        CAST(substr(end_time, 1, 19) AS TIMESTAMP) AS end_time,
        replace(patient_reference, 'urn:uuid:', '') AS patient_reference,
        service_provider_id, service_provider_display, participant_individual_display,
        participant_individual_reference, participant_period_start, participant_period_end,
        participant_type_code, participant_type_display,
        date_diff('second', CAST(substr(start_time, 1, 19) AS TIMESTAMP),
          CAST(substr(end_time, 1, 19) AS TIMESTAMP)) / 60.0 AS encounter_duration
      FROM encounter
      WHERE encounter_id IS NOT NULL AND patient_reference IS NOT NULL AND start_time IS NOT NULL""",
    "ep": """SELECT encounter_id, status, class_code, type_text, start_time, end_time,
        patient_reference, encounter_duration, pat.*,
        CASE WHEN age < 18 THEN 'Child' WHEN age < 40 THEN 'Young Adult' WHEN age < 65
          THEN 'Middle Aged' ELSE 'Senior' END AS age_group
      FROM enc JOIN pat ON patient_reference = patient_id""",
    "fep": """SELECT * FROM ep WHERE encounter_duration <= 86400 OR class_code <> 'Inpatient'""",
    "adc": """SELECT replace(adj.patient_reference, 'urn:uuid:', '') AS patient_reference, adj.eob_id,
        value_cents, adj.currency, category_display, billable_period_start, count(*) AS copies
      FROM adj JOIN eob USING (eob_id) GROUP BY ALL""",
    # The full join behind the amount reports, row counts kept as weights to bound its size.
    "adp": """SELECT adc.*, gender, age, marital_status, age_group, copies * fp.n AS joined
      FROM adc JOIN (SELECT patient_reference, gender, age, marital_status, age_group, count(*) AS n
                     FROM fep GROUP BY ALL) fp USING (patient_reference)""",
    "adr": """SELECT *, CASE lower(trim(category_display))
          WHEN 'line submitted charge amount' THEN 'Submitted Charge'
          WHEN 'line beneficiary coinsurance amount' THEN 'Coinsurance Amount'
          WHEN 'line allowed charge amount' THEN 'Allowed Charge'
          WHEN 'line provider payment amount' THEN 'Provider Payment'
          WHEN 'line beneficiary part b deductible amount' THEN 'Part B Deductible'
          ELSE 'Unknown' END AS category FROM adp""",
    # Claims with every encounter of the patient, row by row.
    "ce": """SELECT claim.patient_reference AS patient_id, claim_id, total_amount, currency,
        insurance_coverage_display, encounter_id, start_time, end_time, service_provider_id,
        service_provider_display, type_text
      FROM claim LEFT JOIN encounter ON claim.patient_reference = encounter.patient_reference""",
    "pv": """SELECT procedure_id, replace(encounter_reference, 'urn:uuid:', '') AS encounter_id,
        procedure_code_display FROM procedure""",
    "feat": """SELECT patient_id, state,
        CAST(coalesce(has_chronic, 0) AS BIGINT) AS has_chronic_conditions,
        round(coalesce(total_claim_amount, 0), 2) AS total_healthcare_cost,
        CAST(trunc(date_diff('day', CAST(birth_date AS DATE), DATE '2024-12-01') / 365.25) AS BIGINT)
          AS age,
        CASE WHEN trunc(date_diff('day', CAST(birth_date AS DATE), DATE '2024-12-01') / 365.25) >= 65
          THEN CAST(1 AS BIGINT) ELSE 0 END AS is_senior,
        CASE WHEN state IN ('CA', 'NY') THEN 0.8 ELSE 0.4 END AS region_risk,
        CASE WHEN trunc(date_diff('day', CAST(birth_date AS DATE), DATE '2024-12-01') / 365.25) > 50
          THEN CAST(1 AS BIGINT) ELSE 0 END AS label,
        coalesce(num_encounters, 0) AS num_encounters,
        coalesce(completed_encounters, 0) AS completed_encounters,
        coalesce(num_claims, 0) AS num_claims,
        round(coalesce(total_claim_amount, 0), 2) AS total_claim_amount,
        coalesce(num_conditions, 0) AS num_conditions, coalesce(num_procedures, 0) AS num_procedures,
        coalesce(num_immunizations, 0) AS num_immunizations,
        coalesce(num_diagnostic_reports, 0) AS num_diagnostic_reports,
        first_encounter, last_encounter
      FROM patient
      LEFT JOIN (SELECT patient_reference AS r, count(encounter_id) AS num_encounters,
          count(*) FILTER (status = 'finished') AS completed_encounters,
          min(start_time) AS first_encounter, max(end_time) AS last_encounter
          FROM encounter GROUP BY 1) e ON e.r = 'urn:uuid:' || patient_id
      LEFT JOIN (SELECT patient_reference AS r, count(claim_id) AS num_claims,
          sum(CAST(CAST(total_amount AS FLOAT) AS DOUBLE)) AS total_claim_amount
          FROM claim GROUP BY 1) c ON c.r = 'urn:uuid:' || patient_id
      LEFT JOIN (SELECT patient_reference AS r, count(condition_id) AS num_conditions,
          max(CASE WHEN regexp_matches(condition_code_display, '(?i)chronic') THEN 1 ELSE 0 END)
            AS has_chronic FROM condition GROUP BY 1) d ON d.r = 'urn:uuid:' || patient_id
      LEFT JOIN (SELECT subject_reference AS r, count(procedure_id) AS num_procedures
          FROM procedure GROUP BY 1) p ON p.r = 'urn:uuid:' || patient_id
      LEFT JOIN (SELECT patient_reference AS r, count(immunization_id) AS num_immunizations
          FROM immunization GROUP BY 1) i ON i.r = 'urn:uuid:' || patient_id
      LEFT JOIN (SELECT subject_reference AS r, count(diagnostic_report_id) AS num_diagnostic_reports
          FROM diagnostic_report GROUP BY 1) g ON g.r = 'urn:uuid:' || patient_id""",
}


def _words(sql: str) -> set[str]:
    return set(re.findall(r"(?:from|join)\s+([a-z_0-9]+)", sql, re.IGNORECASE))


def with_views(sql: str) -> str:
    needed, order = set(), []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name in _words(text) and name not in needed:
                needed.add(name)
                visit(VIEWS[name])
                order.append(name)

    visit(sql)
    if not order:
        return sql
    heads = ", ".join(f"{name} AS ({VIEWS[name]})" for name in order)
    own = re.match(r"\s*WITH\s+(.*)", sql, re.IGNORECASE | re.DOTALL)
    return f"WITH {heads}, {own[1]}" if own else f"WITH {heads} {sql}"


def mean(cents_or_value: str, digits: int = 4) -> str:
    """Rounded average of a column of amounts, summed exactly."""
    return f"round(CAST(sum({cents_or_value}) AS DOUBLE) / count({cents_or_value}) + 1e-9, {digits})"


def exact(amount: str) -> str:
    """An amount of whole cents as an exact decimal."""
    return f"CAST({amount} AS DECIMAL(18, 2))"
