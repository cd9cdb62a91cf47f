"""Reports on the denormalised encounter file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from carelake.operators.shapes import top

DEFAULT_AS_OF = 2023


def _count(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).count()


def _mean(rows: DataFrame, key: str, **columns: str) -> DataFrame:
    return rows.groupBy(key).agg(*(F.avg(c).alias(name) for name, c in columns.items()))


def with_age(rows: DataFrame, year: int = DEFAULT_AS_OF) -> DataFrame:
    return rows.withColumn("Age", F.lit(year) - F.year("BIRTHDATE"))


def demographics(rows):
    return _count(rows, "GENDER", "RACE", "ETHNICITY")


def ages(rows, year: int = DEFAULT_AS_OF):
    return _count(with_age(rows, year), "Age").orderBy("Age")


def marital_statuses(rows):
    return _count(rows, "MARITAL")


def encounters_by_gender(rows):
    return _count(rows, "GENDER", "ENCOUNTER_DESCRIPTION")


def encounter_costs(rows):
    return _mean(
        rows,
        "ENCOUNTER_DESCRIPTION",
        Average_Base_Cost="ENCOUNTER_BASE_COST",
        Average_Claim_Cost="ENCOUNTER_TOTAL_CLAIM_COST",
        Average_Coverage="ENCOUNTER_PAYER_COVERAGE",
    )


def procedure_costs(rows):
    return _mean(rows, "PROCEDURE_DESCRIPTION", Average_Procedure_Cost="PROCEDURE_BASE_COST")


def procedure_coverage(rows):
    return _mean(rows, "PROCEDURE_DESCRIPTION", Average_Coverage="ENCOUNTER_PAYER_COVERAGE")


def _frequent(rows, column: str, k: int):
    return top(_count(rows, column), k, "count", column)


def frequent_procedures(rows, k: int = 10):
    return _frequent(rows, "PROCEDURE_DESCRIPTION", k)


def frequent_reasons(rows, k: int = 10):
    """Encounters without a reason count as one reason, NULL."""
    return _frequent(rows, "ENCOUNTER_REASON_DESCRIPTION", k)


def procedures_by_encounter(rows):
    counts = _count(rows, "ENCOUNTER_DESCRIPTION", "PROCEDURE_DESCRIPTION")
    return counts.orderBy("ENCOUNTER_DESCRIPTION")


def encounters_by_age(rows, year: int = DEFAULT_AS_OF):
    return _count(with_age(rows, year), "Age", "ENCOUNTER_DESCRIPTION").orderBy("Age")


def claim_cost_by_age(rows, year: int = DEFAULT_AS_OF):
    return _mean(with_age(rows, year), "Age", Average_Claim_Cost="ENCOUNTER_TOTAL_CLAIM_COST")


def claim_cost_and_coverage(rows):
    return _mean(
        rows,
        "ENCOUNTER_DESCRIPTION",
        Average_Claim_Cost="ENCOUNTER_TOTAL_CLAIM_COST",
        Average_Coverage="ENCOUNTER_PAYER_COVERAGE",
    )


def base_cost_range(rows):
    return rows.groupBy("ENCOUNTER_DESCRIPTION").agg(
        F.min("ENCOUNTER_BASE_COST").alias("Min_Base_Cost"),
        F.max("ENCOUNTER_BASE_COST").alias("Max_Base_Cost"),
    )


def encounters_by_marital_status(rows):
    return _count(rows, "MARITAL", "ENCOUNTER_DESCRIPTION")


def claim_cost_by_ethnicity(rows):
    return _mean(rows, "ETHNICITY", Average_Cost="ENCOUNTER_TOTAL_CLAIM_COST")


def coverage_and_total_cost(rows):
    return _mean(
        rows,
        "ENCOUNTER_DESCRIPTION",
        Average_Coverage="ENCOUNTER_PAYER_COVERAGE",
        Average_Total_Cost="ENCOUNTER_TOTAL_CLAIM_COST",
    )


def costliest_encounters(rows, k: int = 10):
    cost = "ENCOUNTER_TOTAL_CLAIM_COST"
    return top(rows, k, cost, *(c for c in rows.columns if c != cost))


# The titles the results are stored under.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "Patient Demographics Analysis": demographics,
    "Age Distribution": ages,
    "Marital Status Distribution": marital_statuses,
    "Gender-Based Encounters": encounters_by_gender,
    "Average Encounter Costs": encounter_costs,
    "Cost by Procedure": procedure_costs,
    "Insurance Coverage by Procedure": procedure_coverage,
    "Most Frequent Procedures": frequent_procedures,
    "Frequent Encounter Reasons": frequent_reasons,
    "Procedures per Encounter": procedures_by_encounter,
    "Age-Based Encounter Analysis": encounters_by_age,
    "Age and Cost Relationship": claim_cost_by_age,
    "Coverage vs. Cost": claim_cost_and_coverage,
    "Encounter Cost Variation": base_cost_range,
    "Marital Status and Encounter Types": encounters_by_marital_status,
    "Ethnicity Cost Disparities": claim_cost_by_ethnicity,
    "Encounter Cost-Coverage Relationship": coverage_and_total_cost,
    "Top Expensive Encounters": costliest_encounters,
}


#: The reports that count ages to a year.
DATED = (ages, encounters_by_age, claim_cost_by_age)


def all_reports(rows: DataFrame, year: int = DEFAULT_AS_OF) -> dict[str, DataFrame]:
    return {
        title: report(rows, year) if report in DATED else report(rows)
        for title, report in REPORTS.items()
    }
