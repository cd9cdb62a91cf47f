"""Features of a patient, one row each, for the models.

Every aggregate is grouped by the bare patient key before it is joined on that key, so a join reuses
the partitioning of the aggregate and only the patients are shuffled besides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carelake.functions import codes
from carelake.sources import tables

CHRONIC = "(?i)chronic"
KEY = "patient_id"
COUNTS = (
    "num_encounters",
    "completed_encounters",
    "num_claims",
    "total_claim_amount",
    "num_conditions",
    "num_procedures",
    "num_immunizations",
    "num_diagnostic_reports",
)
ENCOUNTER_SPAN = ("first_encounter", "last_encounter")


#: The reference to the patient in the tables that features are made of.
REFERENCES = {
    "encounter": "patient_reference",
    "claim": "patient_reference",
    "condition": "patient_reference",
    "procedure": "subject_reference",
    "immunization": "patient_reference",
    "diagnostic_report": "subject_reference",
}


def _by_patient(rows: DataFrame, *aggregates, reference: str = "patient_reference") -> DataFrame:
    """By the bare key: the column that `bucketed` has added, or made from the reference."""
    key = F.col(KEY) if KEY in rows.columns else codes.bare_key(F.col(reference)).alias(KEY)
    return rows.groupBy(key).agg(*aggregates)


def bucketed(sources: dict[str, DataFrame], prefix: str, buckets: int) -> dict[str, DataFrame]:
    """The source tables written once more, with the bare patient key and in buckets of it, as the tables
    `<prefix>_<name>` of the session's catalogue. Features of them, and any grouping or join by patient, need
    no shuffle; without it, all of these tables are shuffled for each feature table and each report."""
    out = {}
    for name, table in sources.items():
        keyed = table.withColumn(KEY, codes.bare_key(F.col(REFERENCES[name]))) if name in REFERENCES else table
        out[name] = tables.write_bucketed(keyed, f"{prefix}_{name}", KEY, buckets)
    return out


def _amount(column: str = "total_amount"):
    """Amounts are summed as single-precision values, in double precision."""
    return F.sum(F.col(column).cast("float"))


def chronic_flags(condition: DataFrame) -> DataFrame:
    chronic = condition.filter(F.col("condition_code_display").rlike(CHRONIC))
    return _by_patient(chronic, F.max(F.lit(1)).alias("has_chronic_conditions"))


def healthcare_costs(claim: DataFrame) -> DataFrame:
    return _by_patient(claim, _amount().alias("total_healthcare_cost"))


def encounter_features(encounter: DataFrame, completed: str = codes.FINISHED) -> DataFrame:
    return _by_patient(
        encounter,
        F.count("encounter_id").alias("num_encounters"),
        F.count_if(F.col("status") == completed).alias("completed_encounters"),
        F.min("start_time").alias("first_encounter"),
        F.max("end_time").alias("last_encounter"),
    )


def claim_features(claim: DataFrame) -> DataFrame:
    return _by_patient(
        claim, F.count("claim_id").alias("num_claims"), _amount().alias("total_claim_amount")
    )


def condition_features(condition: DataFrame) -> DataFrame:
    """Number of conditions, and the chronic flag from the same pass."""
    chronic = F.col("condition_code_display").rlike(CHRONIC)
    return _by_patient(
        condition,
        F.count("condition_id").alias("num_conditions"),
        F.max(F.when(chronic, 1).otherwise(0)).alias("has_chronic_conditions"),
    )


def procedure_features(procedure: DataFrame) -> DataFrame:
    number = F.count("procedure_id").alias("num_procedures")
    return _by_patient(procedure, number, reference="subject_reference")


def immunization_features(immunization: DataFrame) -> DataFrame:
    return _by_patient(immunization, F.count("immunization_id").alias("num_immunizations"))


def diagnostic_features(report: DataFrame) -> DataFrame:
    number = F.count("diagnostic_report_id").alias("num_diagnostic_reports")
    return _by_patient(report, number, reference="subject_reference")


def with_chronic_flag(patient: DataFrame, condition: DataFrame) -> DataFrame:
    flagged = patient.join(chronic_flags(condition), KEY, "left")
    return flagged.fillna({"has_chronic_conditions": 0})


def with_healthcare_cost(patient: DataFrame, claim: DataFrame) -> DataFrame:
    return patient.join(healthcare_costs(claim), KEY, "left").fillna({"total_healthcare_cost": 0.0})


def with_derived(patient: DataFrame, as_of: str, states=codes.RISK_STATES, label=None) -> DataFrame:
    """Age in completed years and what follows from it. `label` is a function of the age column; by
    default it tells who is over 50."""
    aged = patient.withColumn("age", codes.age_by_days(F.col("birth_date"), as_of))
    age = F.col("age")
    return aged.withColumns(
        {
            "is_senior": codes.is_senior(age),
            "region_risk": codes.region_risk(F.col("state"), states),
            "label": (label or codes.age_label)(age),
        }
    )


def patient_features(
    patient: DataFrame, condition: DataFrame, claim: DataFrame, as_of: str
) -> DataFrame:
    costed = with_healthcare_cost(with_chronic_flag(patient, condition), claim)
    return with_derived(costed, as_of).select(
        KEY,
        "state",
        "has_chronic_conditions",
        "total_healthcare_cost",
        "age",
        "is_senior",
        "region_risk",
        "label",
    )


def feature_table(
    sources: dict[str, DataFrame],
    as_of: str,
    span: bool = False,
    states=codes.RISK_STATES,
    label=None,
) -> DataFrame:
    """All features of every patient, 0 where a patient has no rows of a kind. `span` adds the first
    and last encounter, which stay NULL then.

    Claims and conditions are aggregated once for all the features that come from them.
    """
    patient = sources["patient"].select(KEY, "state", "birth_date")
    parts = [
        encounter_features(sources["encounter"]),
        claim_features(sources["claim"]),
        condition_features(sources["condition"]),
        procedure_features(sources["procedure"]),
        immunization_features(sources["immunization"]),
        diagnostic_features(sources["diagnostic_report"]),
    ]
    joined = with_derived(patient, as_of, states, label)
    for part in parts:
        joined = joined.join(part, KEY, "left")
    return joined.select(
        KEY,
        "state",
        "has_chronic_conditions",
        F.col("total_claim_amount").alias("total_healthcare_cost"),
        "age",
        "is_senior",
        "region_risk",
        "label",
        *COUNTS,
        *(ENCOUNTER_SPAN if span else ()),
    ).fillna(0)
