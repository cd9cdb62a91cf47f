"""Cost reports on patients, encounters, claims and procedures.

The reports join claims with every encounter of the patient, and procedures with that. All figures
are those of these joins, computed from weights (see `operators.joins`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from carelake.functions import codes
from carelake.operators.joins import counted, mean_of, weight
from carelake.operators.shapes import top, with_share

CLAIM_ORDER = ("claim_id", "currency", "insurance_coverage_display", "patient_id")
ENCOUNTER_ORDER = (
    "encounter_id",
    "type_text",
    "start_time",
    "end_time",
    "service_provider_id",
    "service_provider_display",
)


# --- narrow views of the flat tables --------------------------------------------------------------


def patient_view(patient: DataFrame) -> DataFrame:
    return patient.select("patient_id", "gender", "birth_date")


def claim_view(claim: DataFrame) -> DataFrame:
    """Claim rows; `patient_id` keeps the prefix of the reference."""
    return claim.select(
        F.col("patient_reference").alias("patient_id"),
        "claim_id",
        "total_amount",
        "currency",
        "insurance_coverage_display",
    )


def procedure_view(procedure: DataFrame) -> DataFrame:
    return procedure.select(
        "procedure_id",
        codes.key_after_prefix(F.col("encounter_reference")).alias("encounter_id"),
        "procedure_code_display",
    )


def encounter_view(encounter: DataFrame) -> DataFrame:
    return encounter.select(
        "encounter_id",
        F.col("patient_reference").alias("patient_id"),
        "start_time",
        "end_time",
        "service_provider_id",
        "service_provider_display",
        "type_text",
    )


def one_row_each(view: DataFrame) -> DataFrame:
    """Undo the fan-out of a flat table: the view holds only fields of the document itself, so its
    copies are equal. A report on such views still joins each claim with every encounter of its patient;
    what it leaves out is the repetition of documents, not that of the join."""
    return view.distinct()


# --- claims with encounters, procedures with both -------------------------------------------------


def _claim_totals(claims: DataFrame, key: str = "patient_id") -> DataFrame:
    return claims.groupBy(key).agg(
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("amounts"),
        F.count("*").alias("claim_rows"),
    )


def claims_with_encounters(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    """Left join of claims with the encounters of their patient: each claim row once, with the number
    of encounter rows it meets and the number of joined rows it stands for."""
    met = counted(encounters, "patient_id", into="encounter_rows")
    return claims.join(met, "patient_id", "left").select(
        *claims.columns,
        F.coalesce("encounter_rows", F.lit(0)).alias("encounter_rows"),
        weight(F.col("encounter_rows")).alias("copies"),
    )


def _encounter_totals(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    """Per encounter: rows and amounts it has in the join of claims with encounters."""
    rows = counted(encounters, "encounter_id", "patient_id", into="encounter_rows")
    joined = rows.join(_claim_totals(claims), "patient_id")
    n = F.col("encounter_rows")
    return joined.groupBy("encounter_id").agg(
        F.sum(n * F.col("claim_rows")).alias("joined_rows"),
        F.sum(n * F.col("amount")).alias("amount"),
        F.sum(n * F.col("amounts")).alias("amounts"),
    )


def procedures_with_claims(
    procedures: DataFrame, claims: DataFrame, encounters: DataFrame
) -> DataFrame:
    """Left join of procedures with the claims and encounters above, by encounter: each procedure row
    once, with the number of joined rows it stands for and their summed amount."""
    found = procedures.join(_encounter_totals(claims, encounters), "encounter_id", "left")
    return found.select(
        *procedures.columns,
        weight(F.col("joined_rows")).alias("copies"),
        F.col("amount").alias("joined_amount"),
    )


# --- reports --------------------------------------------------------------------------------------


def costliest_claims(claims: DataFrame, encounters: DataFrame, k: int = 10) -> DataFrame:
    """The `k` joined rows with the largest amount.

    Every claim row has at least one joined row and the order starts with claim columns, so they all
    come from the first `k` claim rows; only the encounters of those patients are joined, and the
    side that is broadcast has `k` rows.
    """
    first = top(claims, k, "total_amount", *CLAIM_ORDER)
    right = encounters.withColumnRenamed("patient_id", "encounter_patient")
    met = right.join(
        F.broadcast(first.select("patient_id").distinct()),
        F.col("encounter_patient") == F.col("patient_id"),
        "left_semi",
    )
    # At most k encounters of each of at most k patients can be listed.
    shown = F.broadcast(_first_rows(met, k, "encounter_patient"))
    pairs = first.join(shown, F.col("patient_id") == F.col("encounter_patient"), "left")
    listed = pairs.select(*claims.columns, *(c for c in encounters.columns if c != "patient_id"))
    return top(listed, k, "total_amount", *CLAIM_ORDER, *ENCOUNTER_ORDER)


def _first_rows(rows: DataFrame, k: int, key: str) -> DataFrame:
    order = Window.partitionBy(key).orderBy(*(F.asc_nulls_first(c) for c in ENCOUNTER_ORDER))
    return rows.withColumn("place", F.row_number().over(order)).filter(f"place <= {k}").drop("place")


def mean_of_costliest(costliest: DataFrame) -> DataFrame:
    """Mean amount per encounter type among the listed rows."""
    return costliest.groupBy("type_text").agg(F.avg("total_amount").alias("avg_amount"))


def _cost_by(claims: DataFrame, encounters: DataFrame, column: str, unmet=None) -> DataFrame:
    """avg_cost, total_cost and num_encounters of the joined rows per value of an encounter column."""
    met = counted(encounters, "patient_id", column, into="encounter_rows")
    joined = _claim_totals(claims).join(met, "patient_id", "left")
    n = weight(F.col("encounter_rows"))
    group = F.col(column) if unmet is None else F.coalesce(column, F.lit(unmet))
    sums = joined.groupBy(group.alias(column)).agg(
        F.sum(F.col("amount") * n).alias("total_cost"),
        F.sum(F.col("amounts") * n).alias("num_encounters"),
    )
    return sums.select(
        column,
        mean_of(F.col("total_cost"), F.col("num_encounters")).alias("avg_cost"),
        "total_cost",
        "num_encounters",
    )


def cost_by_encounter_type(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    return _cost_by(claims, encounters, "type_text")


def cost_by_provider(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    """Blank and missing providers, and claims without an encounter, are `Others`."""
    named = encounters.withColumn(
        "service_provider_display", codes.provider_label(F.col("service_provider_display"))
    )
    return _cost_by(claims, named, "service_provider_display", unmet=codes.OTHER_PROVIDERS)


def claims_with_patients(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Left join on the bare key. Patients are unique, so a patient with very many claims is one key
    whose partition is split at run time (adaptive skew join)."""
    keyed = claims.withColumn("patient_id_clean", codes.key_after_prefix(F.col("patient_id")))
    people = patients.withColumnRenamed("patient_id", "matched_patient_id")
    return keyed.join(people, keyed["patient_id_clean"] == people["matched_patient_id"], "left")


def _claims_by_patient(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Amount per patient, with the patient's columns."""
    keyed = claims.select(
        codes.key_after_prefix(F.col("patient_id")).alias("patient_id"), "total_amount"
    )
    totals = keyed.groupBy("patient_id").agg(F.sum("total_amount").alias("amount"))
    return totals.join(patients, "patient_id", "left")


def cost_by_gender(claims: DataFrame, patients: DataFrame) -> DataFrame:
    totals = _claims_by_patient(claims, patients).groupBy("gender").agg(
        F.sum("amount").alias("total_cost")
    )
    return with_share(totals, "total_cost").orderBy(F.desc("total_cost"))


def cost_by_age_range(claims: DataFrame, patients: DataFrame, as_of: str) -> DataFrame:
    aged = _claims_by_patient(claims, patients).withColumn(
        "age_range", codes.age_range(codes.age_by_year(F.col("birth_date"), as_of))
    )
    return aged.groupBy("age_range").agg(F.sum("amount").alias("total_cost")).orderBy("age_range")


def cost_by_procedure(
    procedures: DataFrame, claims: DataFrame, encounters: DataFrame
) -> DataFrame:
    performed = counted(procedures, "encounter_id", "procedure_code_display", into="times")
    found = performed.join(_encounter_totals(claims, encounters), "encounter_id", "left")
    times, name = F.col("times"), F.col("procedure_code_display")
    sums = found.groupBy(name).agg(
        F.sum(times * F.col("amount")).alias("total_cost"),
        F.sum(times * F.col("amounts")).alias("amounts"),
        F.coalesce(
            F.sum(F.when(name.isNotNull(), times * weight(F.col("joined_rows")))), F.lit(0)
        ).alias("frequency"),
    )
    return sums.select(
        name,
        "total_cost",
        mean_of(F.col("total_cost"), F.col("amounts")).alias("avg_cost"),
        "frequency",
    )


def costliest_procedures(by_procedure: DataFrame, k: int = 10) -> DataFrame:
    return top(by_procedure, k, "total_cost", "procedure_code_display")
