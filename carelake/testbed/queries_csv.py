"""Checked queries: reports on the encounter file."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from carelake.plans import encounter_csv as reports
from carelake.sources import tables
from carelake.testbed.book import Lake, query


def _avg(column: str, name: str) -> str:
    total = f"CAST(sum(CAST(\"{column}\" AS DECIMAL(18, 2))) AS DOUBLE)"
    return f'round({total} / count("{column}") + 1e-9, 4) AS "{name}"'


def _grouped(keys: str, *figures: str) -> str:
    figures = figures or ('count(*) AS "count"',)
    return f"SELECT {keys}, {', '.join(figures)} FROM flat_csv GROUP BY ALL"


AGE = '2023 - year("BIRTHDATE") AS "Age"'
ENCOUNTER, PROCEDURE = '"ENCOUNTER_DESCRIPTION"', '"PROCEDURE_DESCRIPTION"'
CLAIM, COVERAGE = "ENCOUNTER_TOTAL_CLAIM_COST", "ENCOUNTER_PAYER_COVERAGE"
COLUMNS = (
    '"ENCOUNTER_ID", "GENDER", "RACE", "ETHNICITY", "MARITAL", "BIRTHDATE", "ENCOUNTER_DESCRIPTION",'
    ' "ENCOUNTER_REASON_DESCRIPTION", "PROCEDURE_DESCRIPTION", "ENCOUNTER_BASE_COST",'
    ' "ENCOUNTER_PAYER_COVERAGE", "PROCEDURE_BASE_COST"'
)
TOP_ROWS = (
    'SELECT * FROM flat_csv ORDER BY "ENCOUNTER_TOTAL_CLAIM_COST" DESC NULLS LAST, '
    + ", ".join(f"{c.strip()} NULLS FIRST" for c in COLUMNS.split(","))
    + " LIMIT 10"
)


def _frequent(column: str) -> str:
    return f'{_grouped(column)} ORDER BY "count" DESC, {column} NULLS FIRST LIMIT 10'


SQL = {
    "i01_demographics": (reports.demographics, _grouped('"GENDER", "RACE", "ETHNICITY"')),
    "i02_ages": (reports.ages, _grouped(AGE)),
    "i03_marital_statuses": (reports.marital_statuses, _grouped('"MARITAL"')),
    "i04_encounters_by_gender": (
        reports.encounters_by_gender,
        _grouped(f'"GENDER", {ENCOUNTER}'),
    ),
    "i05_encounter_costs": (
        reports.encounter_costs,
        _grouped(
            ENCOUNTER,
            _avg("ENCOUNTER_BASE_COST", "Average_Base_Cost"),
            _avg(CLAIM, "Average_Claim_Cost"),
            _avg(COVERAGE, "Average_Coverage"),
        ),
    ),
    "i06_procedure_costs": (
        reports.procedure_costs,
        _grouped(PROCEDURE, _avg("PROCEDURE_BASE_COST", "Average_Procedure_Cost")),
    ),
    "i07_procedure_coverage": (
        reports.procedure_coverage,
        _grouped(PROCEDURE, _avg(COVERAGE, "Average_Coverage")),
    ),
    "i08_frequent_procedures": (reports.frequent_procedures, _frequent(PROCEDURE)),
    "i09_frequent_reasons": (
        reports.frequent_reasons,
        _frequent('"ENCOUNTER_REASON_DESCRIPTION"'),
    ),
    "i10_procedures_by_encounter": (
        reports.procedures_by_encounter,
        _grouped(f"{ENCOUNTER}, {PROCEDURE}"),
    ),
    "i11_encounters_by_age": (reports.encounters_by_age, _grouped(f"{AGE}, {ENCOUNTER}")),
    "i12_claim_cost_by_age": (
        reports.claim_cost_by_age,
        _grouped(AGE, _avg(CLAIM, "Average_Claim_Cost")),
    ),
    "i13_claim_cost_and_coverage": (
        reports.claim_cost_and_coverage,
        _grouped(ENCOUNTER, _avg(CLAIM, "Average_Claim_Cost"), _avg(COVERAGE, "Average_Coverage")),
    ),
    "i14_base_cost_range": (
        reports.base_cost_range,
        _grouped(
            ENCOUNTER,
            'round(min("ENCOUNTER_BASE_COST") + 1e-9, 4) AS "Min_Base_Cost"',
            'round(max("ENCOUNTER_BASE_COST") + 1e-9, 4) AS "Max_Base_Cost"',
        ),
    ),
    "i15_encounters_by_marital_status": (
        reports.encounters_by_marital_status,
        _grouped(f'"MARITAL", {ENCOUNTER}'),
    ),
    "i16_claim_cost_by_ethnicity": (
        reports.claim_cost_by_ethnicity,
        _grouped('"ETHNICITY"', _avg(CLAIM, "Average_Cost")),
    ),
    "i17_coverage_and_total_cost": (
        reports.coverage_and_total_cost,
        _grouped(ENCOUNTER, _avg(COVERAGE, "Average_Coverage"), _avg(CLAIM, "Average_Total_Cost")),
    ),
    "i18_costliest_encounters": (
        reports.costliest_encounters,
        f"""SELECT * REPLACE (strftime("BIRTHDATE", '%Y-%m-%d') AS "BIRTHDATE",
              round("ENCOUNTER_BASE_COST" + 1e-9, 4) AS "ENCOUNTER_BASE_COST",
              round("ENCOUNTER_TOTAL_CLAIM_COST" + 1e-9, 4) AS "ENCOUNTER_TOTAL_CLAIM_COST",
              round("ENCOUNTER_PAYER_COVERAGE" + 1e-9, 4) AS "ENCOUNTER_PAYER_COVERAGE",
              round("PROCEDURE_BASE_COST" + 1e-9, 4) AS "PROCEDURE_BASE_COST") FROM ({TOP_ROWS})""",
    ),
}
for name, (report, sql) in SQL.items():
    query(name, sql)(lambda lake, report=report: report(lake.csv()))


@query(
    "s04_rows_of_the_file",
    """SELECT "GENDER", "MARITAL", count(*) AS n, count("ENCOUNTER_REASON_DESCRIPTION") AS reasons,
         strftime(min("BIRTHDATE"), '%Y-%m-%d') AS oldest,
         CAST(sum(CAST("ENCOUNTER_BASE_COST" AS DECIMAL(18, 2))) AS DOUBLE) AS base_cost
       FROM flat_csv GROUP BY ALL""",
    money=("base_cost",),
)
def _(lake: Lake):
    """The file's lines as text, through the CSV parser with the declared types."""
    made = lake.csv()
    lines = made.select(F.to_csv(F.struct(*made.columns)).alias("line"))
    declared = ", ".join(f"{name} {kind}" for name, kind in made.dtypes)
    read = lines.select(F.from_csv("line", declared).alias("r")).select("r.*")
    return read.groupBy("GENDER", "MARITAL").agg(
        F.count("*").alias("n"),
        F.count("ENCOUNTER_REASON_DESCRIPTION").alias("reasons"),
        F.min("BIRTHDATE").alias("oldest"),
        F.sum("ENCOUNTER_BASE_COST").alias("base_cost"),
    )


@query(
    "i19_all_reports",
    " UNION ALL ".join(
        f"SELECT '{title}' AS title, count(*) AS n FROM ({sql})"
        for title, (_, sql) in zip(reports.REPORTS, SQL.values())
    ),
)
def _(lake: Lake):
    # as a table, for the file is made by joins and each report would make them again
    rows = tables.kept(lake.csv(), tables.shared_folder(lake.spark), f"encounters-{uuid.uuid4().hex}")
    sizes = [
        result.agg(F.count("*").alias("n")).select(F.lit(title).alias("title"), "n")
        for title, result in reports.all_reports(rows).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), sizes)
