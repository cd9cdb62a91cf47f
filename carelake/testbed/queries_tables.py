"""Checked queries: sources, flat tables, profile, code maps and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carelake.functions import codes
from carelake.operators import flatten, profile
from carelake.sources import bundles
from carelake.testbed import star
from carelake.testbed.book import Lake, query
from carelake.testbed.oracle_views import VIEWS


def _adjudication_text(lines) -> F.col:
    cents = lambda x: F.coalesce(F.round(x["amount"]["value"] * 100).cast("long").cast("string"), F.lit("none"))
    label = lambda x: F.get(x["category"]["coding"], F.lit(0))["display"]
    return F.array_join(F.transform(lines, lambda x: F.concat_ws("=", label(x), cents(x))), "|")


def _as_text(table: DataFrame) -> DataFrame:
    """Array columns as text."""
    for name, kind in table.dtypes:
        c = F.col(name)
        if name == "adjudication":
            c = F.when(c.isNotNull(), _adjudication_text(c))
        elif name == "name":
            c = F.array_join(F.transform(c, lambda x: x["family"]), "|")
        elif kind.startswith("array"):
            c = F.array_join(c, "|")
        else:
            continue
        table = table.withColumn(name, c)
    return table


def _rounded(columns: str, names=()) -> str:
    return ", ".join(f"round({c} + 1e-9, 4) AS {c}" if c in names else c for c in columns.split())


COLUMNS = {
    "patient": (
        "patient_id identifier_types name gender birth_date city state country postal_code latitude"
        " longitude phone marital_status mothers_maiden_name birthplace_city birthplace_state"
        " birthplace_country disability_adjusted_life_years quality_adjusted_life_years"
        " multiple_birth languages",
        ("disability_adjusted_life_years", "quality_adjusted_life_years", "latitude", "longitude"),
    ),
    "encounter": (
        "encounter_id status class_code type_text start_time end_time patient_reference"
        " service_provider_id service_provider_display participant_individual_display"
        " participant_individual_reference participant_period_start participant_period_end"
        " participant_type_code participant_type_display",
        (),
    ),
    "condition": ("*", ()),
    "medication_request": ("*", ()),
    "claim": (
        "claim_id status type_code use patient_reference patient_display created_date"
        " billable_period_start billable_period_end provider_reference priority supporting_info_code"
        " supporting_info_value_reference insurance_coverage_display insurance_focal total_amount"
        " currency diagnosis_reference item_code item_description item_category item_net_value"
        " item_net_currency encounter_reference location_description service_period_start"
        " service_period_end adjudication",
        ("total_amount", "item_net_value"),
    ),
    "explanation_of_benefit": (
        "eob_id identifier_claim_id identifier_claim_group status code use patient_reference"
        " billable_period_start billable_period_end insurer_display provider_reference"
        " referral_reference claim_reference outcome care_team_provider_reference care_team_role"
        " insurance_coverage_reference insurance_coverage_display insurance_focal"
        " item_category_display item_service_code item_service_description item_net_value"
        " item_net_currency location_description service_period_start service_period_end"
        " adjudication total_amount total_currency payment_amount payment_currency created_date",
        ("total_amount", "item_net_value", "payment_amount"),
    ),
    "careplan": ("*", ()),
    "careteam": ("*", ()),
    "procedure": ("*", ()),
    "diagnostic_report": ("*", ()),
    "immunization": ("*", ()),
    "observation": (
        "observation_id status observation_code_display observation_code subject_reference"
        " encounter_reference effective_date_time issued_date value_quantity_value"
        " value_quantity_unit category_display",
        ("value_quantity_value",),
    ),
}
SQL_NAME = {"explanation_of_benefit": "eob"}

for number, name in enumerate(flatten.TABLES, 1):
    columns, rounded = COLUMNS[name]
    query(
        f"r{number:02d}_{name}",
        f"SELECT {_rounded(columns, rounded)} FROM {SQL_NAME.get(name, name)}",
    )(lambda lake, name=name: _as_text(lake.from_documents(name)))


# Rows of the outer form, which keeps resources without elements.
@query(
    "g03_claim_fan_out",
    """SELECT 'c' || o_orderkey AS claim_id,
         greatest(o_orderkey % 3, 1) * greatest((o_orderkey // 3) % 3, 1) * (1 + (o_orderkey // 9) % 3)
           AS outer_rows,
         (o_orderkey % 3) * ((o_orderkey // 3) % 3) * (1 + (o_orderkey // 9) % 3) AS inner_rows
       FROM orders""",
)
def _(lake: Lake):
    outer = flatten.claim(star.entries(lake.spark, lake.sf_dir, "claim"), outer=True)
    lost = F.col("diagnosis_reference").isNull() | F.col("supporting_info_code").isNull()
    return outer.groupBy("claim_id").agg(
        F.count("*").alias("outer_rows"), F.count_if(~lost).alias("inner_rows")
    )


@query(
    "b01_procedures_without_reason_kept",
    """SELECT l_returnflag = 'N' AS without_reason, sum(CASE WHEN l_returnflag = 'N' THEN 1
         ELSE 1 + l_linenumber % 2 END)::BIGINT AS n FROM lineitem GROUP BY 1""",
)
def _(lake: Lake):
    outer = flatten.procedure(star.entries(lake.spark, lake.sf_dir, "procedure"), outer=True)
    return outer.groupBy(F.isnull("reason_reference").alias("without_reason")).agg(
        F.count("*").alias("n")
    )


@query(
    "s01_bundle_entries",
    """SELECT 'Patient' AS resource_type, count(*) AS n FROM customer
       UNION ALL SELECT unnest(['Encounter', 'Claim', 'ExplanationOfBenefit', 'CarePlan', 'CareTeam']),
         count(*) FROM orders GROUP BY 1
       UNION ALL SELECT unnest(['Condition', 'MedicationRequest', 'Procedure']), count(*)
         FROM lineitem GROUP BY 1
       UNION ALL SELECT CASE WHEN event_type IN ('view', 'click') THEN 'Observation'
         WHEN event_type = 'signup' THEN 'Immunization' ELSE 'DiagnosticReport' END, count(*)
         FROM events GROUP BY 1""",
)
def _(lake: Lake):
    documents = star.documents(lake.spark, lake.sf_dir, *flatten.TABLES)
    entries = bundles.entries(bundles.parse_bundles(documents, F.col("document")))
    return entries.groupBy(F.col("entry.resource.resourceType").alias("resource_type")).agg(
        F.count("*").alias("n")
    )


# --- S12 -----------------------------------------------------------------------------------------

PROFILED = (
    "encounter_id status type_text start_time end_time patient_reference service_provider_id"
    " service_provider_display participant_individual_display participant_individual_reference"
    " participant_period_start participant_period_end participant_type_code"
    " participant_type_display".split()
)


@query(
    "s12_profile",
    " UNION ALL ".join(
        f"""SELECT class_code, '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS nulls,
          count({c}) > 0 AS has_value,
          count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END > 1 AS varies
        FROM encounter GROUP BY class_code"""
        for c in PROFILED
    ),
)
def _(lake: Lake):
    return profile.profile(lake.table("encounter"), "class_code")


VARYING = " UNION ALL ".join(
    f"""SELECT class_code, '{c}' AS name, count(DISTINCT {c})
          + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END > 1 AS varies
        FROM encounter GROUP BY class_code"""
    for c in PROFILED
)


@query(
    "s12_informative_columns",
    f"""SELECT class_code, string_agg(name, ', ' ORDER BY name) AS all_columns,
          string_agg(name, ', ' ORDER BY name) FILTER (varies) AS informative_columns
        FROM ({VARYING}) GROUP BY class_code""",
)
def _(lake: Lake):
    found = profile.profile(lake.table("encounter"), "class_code")
    lists = profile.column_lists(found, "class_code")
    return lists.select(
        "class_code",
        *(F.array_join(c, ", ").alias(c) for c in ("all_columns", "informative_columns")),
    )


@query(
    "s12_distinct_counts",
    " UNION ALL ".join(
        f"""SELECT class_code, '{c}' AS "column", count(DISTINCT {c}) AS distinct_values
        FROM encounter GROUP BY class_code"""
        for c in PROFILED
    ),
)
def _(lake: Lake):
    return profile.distinct_counts(lake.table("encounter"), "class_code")


@query(
    "s12_sample_rows",
    """SELECT * FROM (SELECT class_code, encounter_id, status, type_text,
         row_number() OVER (PARTITION BY class_code ORDER BY encounter_id NULLS FIRST,
           participant_individual_reference NULLS FIRST) AS "row" FROM encounter) WHERE "row" <= 20""",
)
def _(lake: Lake):
    rows = profile.sample_rows(
        lake.table("encounter"),
        "class_code",
        ["encounter_id", "participant_individual_reference"],
    )
    return rows.select("class_code", "encounter_id", "status", "type_text", "row")


PERIOD = "coalesce(start_iso, '') || '/' || coalesce(end_iso, '')"
PEOPLE = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
ORDER = dict(id="o_orderkey", status="o_orderstatus = 'O'", subject="o_custkey", encounter="o_orderkey", period=PERIOD)
LINE = dict(id="line_key", status="l_linestatus = 'O'", subject="o_custkey", encounter="l_orderkey")
EVENT = dict(id="event_id", status="1", encounter="event_id")
ACT = dict(**EVENT, subject="user_id", category="event_type", effectiveDateTime="ts_iso", issued="ts_iso")
BILL = dict(id="o_orderkey", status="1", use="1", patient="o_custkey", billablePeriod=PERIOD, created="end_iso", type="o_orderkey % 2", provider="o_orderkey % 37", insurance="o_orderpriority", total="o_totalprice")
#: Per type its rows and, per field, something that is NULL where the field is absent and differs where it does.
FIELDS = {
    "Patient": (PEOPLE, dict(
        id="c_custkey", identifier="c_custkey % 3 = 0", name="c_name", gender="CASE WHEN c_custkey % 50 <> 7 THEN c_custkey % 2 END",
        birthDate="concat_ws('-', (c_custkey * 37) % 90, c_custkey % 12, c_custkey % 28)",
        address="concat_ws('-', n_name, r_name, c_custkey % 7 = 0, c_custkey % 180, c_custkey % 1000)", telecom="c_custkey % 10000",
        maritalStatus="c_custkey % 4", extension="concat_ws('-', c_custkey % 100, n_name, c_acctbal)",
        multipleBirthBoolean="c_custkey % 11 = 0", communication="c_nationkey % 2")),
    "Encounter": ("o", {**{k: v for k, v in ORDER.items() if k != "encounter"}, "type": "o_orderpriority", "serviceProvider": "o_orderkey % 370",
        "participant": f"CASE WHEN (o_orderkey // 4) % 4 > 0 THEN concat_ws('-', (o_orderkey // 4) % 4, o_orderkey % 89, {PERIOD}) END",
        "class": "o_orderkey % 4"}),
    "Condition": ("ln", {k: v for k, v in LINE.items() if k != "status"} | dict(
        clinicalStatus="l_linestatus = 'O'", verificationStatus="1", code="concat_ws('-', p_type, p_name, p_size % 10)",
        onsetDateTime="ship_iso", recordedDate="ship_iso", abatementDateTime="CASE WHEN l_linestatus <> 'O' THEN ship_iso END")),
    "MedicationRequest": ("ln", LINE | dict(intent="1", medicationCodeableConcept="p_type || p_name", requester="l_suppkey",
        authoredOn="ship_iso", dosageInstruction="nullif(l_linenumber % 3, 0)")),
    "Claim": ("o", BILL | dict(priority="1", supportingInfo="CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END",
        diagnosis="CASE WHEN (o_orderkey // 3) % 3 > 0 THEN o_orderkey END", item="o_orderkey")),
    "ExplanationOfBenefit": ("o", BILL | dict(identifier="o_orderkey", insurer="o_orderpriority", referral="1", claim="o_orderkey", outcome="1",
        careTeam="o_orderkey % 178", contained="(o_orderkey // 2) % 2", item="concat_ws('-', o_orderkey % 500, cents)", payment="cents * 4 // 5")),
    "CarePlan": ("o", ORDER | dict(intent="1", category="o_orderpriority", careTeam="o_orderkey", addresses="o_orderkey",
        activity="CASE WHEN (o_orderkey // 2) % 3 > 0 THEN concat_ws('-', (o_orderkey // 2) % 3, o_orderstatus = 'O', o_orderkey % 37) END")),
    "CareTeam": ("o", ORDER | dict(participant="concat_ws('-', o_orderkey % 3, o_orderkey % 89)",
        managingOrganization="CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 37 END")),
    "Procedure": ("ln", LINE | dict(status="1", code="p_size || p_type", performedPeriod="ship_iso",
        reasonReference="CASE WHEN l_returnflag <> 'N' THEN line_key END")),
    "DiagnosticReport": ("ev WHERE event_type IN ('purchase', 'error')", ACT | dict(code="event_id % 7", result="CASE WHEN event_id % 4 > 0 THEN event_id END")),
    "Immunization": ("ev WHERE event_type = 'signup'", EVENT | dict(vaccineCode="event_id % 9", patient="user_id", primarySource="event_id % 3 > 0", occurrenceDateTime="ts_iso")),
    "Observation": ("ev WHERE event_type IN ('view', 'click')", ACT | dict(code="event_id % 13", valueQuantity="coalesce(value, -1)")),
}
EVERY_FIELD = sorted({f for _, fields in FIELDS.values() for f in fields} | {"resourceType"})


def _field_counts(kind: str) -> str:
    source, fields = FIELDS[kind]
    fields = {"resourceType": "1"} | fields
    each = ", ".join(
        f"{{'f': '{f}', 'c': count({fields.get(f, 'NULL')}), 'd': count(DISTINCT {fields.get(f, 'NULL::INT')})}}" for f in EVERY_FIELD
    )
    return f"""SELECT '{kind}' AS resource_type, n AS "rows", unnest(x) AS s FROM (SELECT count(*) AS n, [{each}] AS x FROM {source})"""


@query(
    "s12_resource_profile",
    """SELECT resource_type, s.f AS "column", "rows", "rows" - s.c AS nulls, s.c > 0 AS has_value,
         s.c > 0 AND s.d + CASE WHEN s.c < "rows" THEN 1 ELSE 0 END > 1 AS varies
       FROM ("""
    + " UNION ALL ".join(map(_field_counts, FIELDS))
    + """) WHERE "rows" > 0""",
)
def _(lake: Lake):
    return profile.resource_profile(lake.resource_texts())


# --- code maps: raw value, label and rows -------------------------------------------------------


def _map(table: DataFrame, column: str, label) -> DataFrame:
    return table.groupBy(F.col(column).alias("raw"), label.alias("label")).agg(
        F.count("*").alias("n")
    )


@query(
    "k01_marital_status",
    """SELECT marital_status AS raw, CASE trim(lower(marital_status)) WHEN 'm' THEN 'Married'
         WHEN 's' THEN 'Single' WHEN 'never married' THEN 'Never Married' ELSE 'Unknown' END AS label,
         count(*) AS n FROM patient GROUP BY ALL""",
)
def _(lake: Lake):
    return _map(
        lake.table("patient"), "marital_status", codes.marital_label(F.col("marital_status"))
    )


@query(
    "k02_encounter_status",
    """SELECT status AS raw, CASE WHEN status = 'finished' THEN 'Completed' ELSE 'In-Progress' END
         AS label, count(*) AS n FROM encounter GROUP BY ALL""",
)
def _(lake: Lake):
    return _map(lake.table("encounter"), "status", codes.status_label(F.col("status")))


@query(
    "k03_encounter_class",
    """SELECT class_code AS raw, CASE class_code WHEN 'IMP' THEN 'Inpatient' WHEN 'AMB' THEN
         'Ambulatory' WHEN 'EMER' THEN 'Emergency' ELSE 'Unknown' END AS label, count(*) AS n
       FROM encounter GROUP BY ALL""",
)
def _(lake: Lake):
    return _map(lake.table("encounter"), "class_code", codes.class_label(F.col("class_code")))


@query(
    "k04_k05_age_bands",
    """SELECT age, CASE WHEN age < 18 THEN 'Child' WHEN age < 40 THEN 'Young Adult' WHEN age < 65 THEN
         'Middle Aged' ELSE 'Senior' END AS age_group,
         CASE WHEN age <= 18 THEN '0-18' WHEN age <= 35 THEN '19-35' WHEN age <= 50 THEN '36-50'
         WHEN age <= 65 THEN '51-65' ELSE '66+' END AS age_range, count(*) AS n FROM pat GROUP BY ALL""",
)
def _(lake: Lake):
    age = F.col("age")
    return lake.clean_patients().groupBy(
        age, codes.age_group(age).alias("age_group"), codes.age_range(age).alias("age_range")
    ).agg(F.count("*").alias("n"))


@query(
    "k06_provider",
    """SELECT service_provider_display AS raw, CASE WHEN service_provider_display IS NULL
         OR service_provider_display = '' THEN 'Others' ELSE service_provider_display END AS label,
         count(*) AS n FROM encounter GROUP BY ALL""",
)
def _(lake: Lake):
    column = "service_provider_display"
    return _map(lake.table("encounter"), column, codes.provider_label(F.col(column)))


@query(
    "k08_risk_flags",
    """SELECT patient_id, is_senior, round(region_risk + 1e-9, 4) AS region_risk, label FROM feat""",
)
def _(lake: Lake):
    age = codes.age_by_days(F.col("birth_date"), star.AS_OF)
    return lake.table("patient").select(
        "patient_id",
        codes.is_senior(age).alias("is_senior"),
        codes.region_risk(F.col("state")).alias("region_risk"),
        codes.age_label(age).alias("label"),
    )


@query(
    "x05_x06_keys",
    """SELECT raw, replace(raw, 'urn:uuid:', '') AS bare,
         CASE WHEN contains(raw, 'urn:uuid:') THEN replace(raw, 'urn:uuid:', '') END AS after_prefix,
         count(*) AS n
       FROM (SELECT patient_reference AS raw FROM encounter
             UNION ALL SELECT service_provider_id FROM encounter) GROUP BY ALL""",
)
def _(lake: Lake):
    encounter = lake.table("encounter")
    keys = encounter.select(F.col("patient_reference").alias("raw")).unionByName(
        encounter.select(F.col("service_provider_id").alias("raw"))
    )
    raw = F.col("raw")
    return keys.groupBy(
        raw, codes.bare_key(raw).alias("bare"), codes.key_after_prefix(raw).alias("after_prefix")
    ).agg(F.count("*").alias("n"))


@query(
    "x10_x12_ages",
    """SELECT patient_id, 2024 - year(CAST(birth_date AS DATE)) AS by_year,
         CAST(trunc(date_diff('day', CAST(birth_date AS DATE), DATE '2024-12-01') / 365.25) AS BIGINT)
           AS by_days FROM patient""",
)
def _(lake: Lake):
    birth = F.col("birth_date")
    return lake.table("patient").select(
        "patient_id",
        codes.age_by_year(birth, star.AS_OF).alias("by_year"),
        codes.age_by_days(birth, star.AS_OF).alias("by_days"),
    )


assert set(VIEWS) >= {SQL_NAME.get(t, t) for t in flatten.TABLES}
