"""Checked queries: cost reports. The SQL lays the joins out row by row."""

from __future__ import annotations

from carelake.plans import cost
from carelake.testbed import star
from carelake.testbed.book import Lake, query

# Money is summed exactly on the SQL side.
AMOUNT = "CAST(total_amount AS DECIMAL(18, 2))"
TOTAL = f"CAST(sum({AMOUNT}) AS DOUBLE)"
AVERAGE = f"round({TOTAL} / nullif(count(total_amount), 0) + 1e-9, 4)"
MONEY = ("total_cost",)
PROVIDER = "CASE WHEN {0} IS NULL OR {0} = '' THEN 'Others' ELSE {0} END".format(
    "service_provider_display"
)
ONCE = """(SELECT c.*, e.type_text, e.service_provider_display FROM
  (SELECT DISTINCT patient_reference AS patient_id, claim_id, total_amount, currency,
     insurance_coverage_display FROM claim) c
  LEFT JOIN (SELECT DISTINCT encounter_id, patient_reference, type_text, service_provider_display
     FROM encounter) e ON c.patient_id = e.patient_reference)"""


@query("c01_patients", "SELECT patient_id, gender, birth_date FROM patient")
def _(lake: Lake):
    return lake.people()


@query(
    "c01_claims",
    """SELECT patient_reference AS patient_id, claim_id, round(total_amount + 1e-9, 4) AS total_amount,
         currency, insurance_coverage_display FROM claim""",
)
def _(lake: Lake):
    return lake.claims()


@query(
    "c01_encounters",
    """SELECT encounter_id, patient_reference AS patient_id, start_time, end_time, service_provider_id,
         service_provider_display, type_text FROM encounter""",
)
def _(lake: Lake):
    return lake.encounters()


@query("c01_procedures", "SELECT procedure_id, encounter_id, procedure_code_display FROM pv")
def _(lake: Lake):
    return lake.procedures()


@query(
    "c02_claims_with_encounters",
    """WITH met AS (SELECT patient_reference, count(*) AS n FROM encounter GROUP BY 1)
       SELECT claim.patient_reference AS patient_id, claim_id,
         round(total_amount + 1e-9, 4) AS total_amount, currency, insurance_coverage_display,
         coalesce(n, 0) AS encounter_rows, coalesce(n, 1) AS copies
       FROM claim LEFT JOIN met ON claim.patient_reference = met.patient_reference""",
)
def _(lake: Lake):
    return cost.claims_with_encounters(lake.claims(), lake.encounters())


@query(
    "c02_joined_rows",
    """SELECT patient_id, count(*) AS joined_rows FROM ce GROUP BY 1""",
)
def _(lake: Lake):
    from pyspark.sql import functions as F

    rows = cost.claims_with_encounters(lake.claims(), lake.encounters())
    return rows.groupBy("patient_id").agg(F.sum("copies").alias("joined_rows"))


@query(
    "c03_procedures_with_claims",
    f"""SELECT procedure_id, pv.encounter_id, procedure_code_display, sum(coalesce(n, 1))::BIGINT
          // count(*) AS copies, max(amount) AS joined_amount
        FROM pv LEFT JOIN (SELECT encounter_id, count(*) AS n, {TOTAL} AS amount FROM ce GROUP BY 1) j
          ON pv.encounter_id = j.encounter_id
        GROUP BY procedure_id, pv.encounter_id, procedure_code_display, reason_row
        """.replace("FROM pv", "FROM (SELECT *, row_number() OVER () AS reason_row FROM pv) pv"),
    money=("joined_amount",),
)
def _(lake: Lake):
    return cost.procedures_with_claims(lake.procedures(), lake.claims(), lake.encounters())


CLAIM_COLUMNS = "patient_id, claim_id, total_amount, currency, insurance_coverage_display"
ENCOUNTER_COLUMNS = (
    "encounter_id, start_time, end_time, service_provider_id, service_provider_display, type_text"
)
TOP_CLAIMS = f"""SELECT {CLAIM_COLUMNS}, {ENCOUNTER_COLUMNS} FROM ce
  ORDER BY total_amount DESC NULLS LAST, claim_id NULLS FIRST, currency NULLS FIRST,
    insurance_coverage_display NULLS FIRST, patient_id NULLS FIRST, encounter_id NULLS FIRST,
    type_text NULLS FIRST, start_time NULLS FIRST, end_time NULLS FIRST LIMIT 10"""


@query("c04_costliest_claims", TOP_CLAIMS)
def _(lake: Lake):
    return cost.costliest_claims(lake.claims(), lake.encounters())


@query(
    "c04_mean_of_costliest",
    f"""SELECT type_text, round({TOTAL} / count(*) + 1e-9, 4) AS avg_amount
        FROM ({TOP_CLAIMS}) GROUP BY 1""",
)
def _(lake: Lake):
    return cost.mean_of_costliest(cost.costliest_claims(lake.claims(), lake.encounters()))


@query(
    "c05_cost_by_encounter_type",
    f"""SELECT type_text, {AVERAGE} AS avg_cost, {TOTAL} AS total_cost,
          count(total_amount) AS num_encounters FROM ce GROUP BY 1""",
    money=MONEY,
)
def _(lake: Lake):
    return cost.cost_by_encounter_type(lake.claims(), lake.encounters())


@query(
    "c05_cost_by_encounter_type_of_distinct_rows",
    f"""SELECT type_text, {AVERAGE} AS avg_cost, {TOTAL} AS total_cost,
          count(total_amount) AS num_encounters FROM {ONCE} GROUP BY 1""",
    money=MONEY,
)
def _(lake: Lake):
    return cost.cost_by_encounter_type(
        cost.one_row_each(lake.claims()), cost.one_row_each(lake.encounters())
    )


@query(
    "c06_cost_by_provider",
    f"""SELECT {PROVIDER} AS service_provider_display, {AVERAGE} AS avg_cost, {TOTAL} AS total_cost,
          count(total_amount) AS num_encounters FROM ce GROUP BY 1""",
    money=MONEY,
)
def _(lake: Lake):
    return cost.cost_by_provider(lake.claims(), lake.encounters())


@query(
    "c06_cost_by_provider_of_distinct_rows",
    f"""SELECT {PROVIDER} AS service_provider_display, {AVERAGE} AS avg_cost, {TOTAL} AS total_cost,
          count(total_amount) AS num_encounters FROM {ONCE} GROUP BY 1""",
    money=MONEY,
)
def _(lake: Lake):
    return cost.cost_by_provider(
        cost.one_row_each(lake.claims()), cost.one_row_each(lake.encounters())
    )


@query(
    "c07_claims_with_patients",
    """SELECT patient_reference AS patient_id, claim_id, round(total_amount + 1e-9, 4) AS total_amount,
         currency, insurance_coverage_display, replace(patient_reference, 'urn:uuid:', '')
           AS patient_id_clean, patient.patient_id AS matched_patient_id, gender, birth_date
       FROM claim LEFT JOIN patient
         ON replace(patient_reference, 'urn:uuid:', '') = patient.patient_id""",
)
def _(lake: Lake):
    return cost.claims_with_patients(lake.claims(), lake.people())


CLAIM_PATIENTS = """claim LEFT JOIN patient
  ON replace(patient_reference, 'urn:uuid:', '') = patient.patient_id"""


@query(
    "c08_cost_by_gender",
    f"""SELECT gender, {TOTAL} AS total_cost,
          round({TOTAL} / sum({TOTAL}) OVER () + 1e-9, 4) AS share
        FROM {CLAIM_PATIENTS} GROUP BY 1""",
    money=MONEY,
)
def _(lake: Lake):
    return cost.cost_by_gender(lake.claims(), lake.people())


@query(
    "c09_cost_by_age_range",
    f"""SELECT CASE WHEN age <= 18 THEN '0-18' WHEN age <= 35 THEN '19-35' WHEN age <= 50 THEN '36-50'
          WHEN age <= 65 THEN '51-65' ELSE '66+' END AS age_range, {TOTAL} AS total_cost
        FROM (SELECT total_amount, 2024 - CAST(substr(birth_date, 1, 4) AS BIGINT) AS age
              FROM {CLAIM_PATIENTS}) GROUP BY 1""",
    money=MONEY,
)
def _(lake: Lake):
    return cost.cost_by_age_range(lake.claims(), lake.people(), star.AS_OF)


BY_PROCEDURE = f"""SELECT procedure_code_display, {TOTAL} AS total_cost, {AVERAGE} AS avg_cost,
    count(procedure_code_display) AS frequency
  FROM pv LEFT JOIN ce ON pv.encounter_id = ce.encounter_id GROUP BY 1"""


@query("c10_cost_by_procedure", BY_PROCEDURE, money=MONEY)
def _(lake: Lake):
    return cost.cost_by_procedure(lake.procedures(), lake.claims(), lake.encounters())


@query(
    "c11_costliest_procedures",
    f"SELECT * FROM ({BY_PROCEDURE}) ORDER BY total_cost DESC NULLS LAST, procedure_code_display LIMIT 10",
    money=MONEY,
)
def _(lake: Lake):
    by_procedure = cost.cost_by_procedure(lake.procedures(), lake.claims(), lake.encounters())
    return cost.costliest_procedures(by_procedure)
