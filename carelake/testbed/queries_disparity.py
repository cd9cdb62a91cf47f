"""Checked queries: disparity reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from carelake.functions import codes
from carelake.operators import sketches
from carelake.plans import disparity as d
from carelake.sources import tables
from carelake.testbed.book import Lake, query

DURATION = "round(avg(encounter_duration) + 1e-9, 4)"
KNOWN = """encounter_id, status, class_code, type_text,
  strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
  strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, patient_reference,
  round(encounter_duration + 1e-9, 4) AS encounter_duration, patient_id, gender, birth_date, state,
  postal_code, marital_status,
  round(disability_adjusted_life_years + 1e-9, 4) AS disability_adjusted_life_years,
  round(quality_adjusted_life_years + 1e-9, 4) AS quality_adjusted_life_years, age, age_group"""
TIES = ", ".join(f"{c} NULLS FIRST" for c in d.ENCOUNTER_TIES)


# --- patients -------------------------------------------------------------------------------------


@query("d01_number_of_cities", "SELECT count(DISTINCT city) AS cities FROM patient")
def _(lake: Lake):
    return d.distinct_count(lake.table("patient"), "city", "cities")


for column in ("city", "state", "marital_status", "gender"):
    query(f"d01_distinct_{column}", f"SELECT DISTINCT {column} FROM patient")(
        lambda lake, column=column: d.distinct_values(lake.table("patient"), column)
    )


@query("d01_languages", "SELECT languages FROM patient")
def _(lake: Lake):
    from pyspark.sql import functions as F

    return lake.table("patient").select(F.array_join("languages", "|").alias("languages"))


@query(
    "d02_clean_patients",
    """SELECT patient_id, gender, birth_date, state, postal_code, marital_status,
         round(disability_adjusted_life_years + 1e-9, 4) AS disability_adjusted_life_years,
         round(quality_adjusted_life_years + 1e-9, 4) AS quality_adjusted_life_years, age FROM pat""",
)
def _(lake: Lake):
    return lake.clean_patients()


@query("d03_missing_ids", "SELECT count(*) AS missing FROM pat WHERE patient_id IS NULL")
def _(lake: Lake):
    return d.missing_ids(lake.clean_patients())


for column in ("gender", "marital_status", "age"):
    query(f"d04_patients_by_{column}", f'SELECT {column}, count(*) AS "count" FROM pat GROUP BY 1')(
        lambda lake, column=column: d.counts_by(lake.clean_patients(), column)
    )

AGES = "round(avg(age) + 1e-9, 4) AS average_age, round(stddev_samp(age) + 1e-9, 4) AS stddev_age"


@query("d05_age_statistics", f"SELECT {AGES} FROM pat")
def _(lake: Lake):
    return d.age_statistics(lake.clean_patients())


@query(
    "d06_age_by_gender_and_marital_status",
    f'SELECT gender, marital_status, {AGES}, count(*) AS "count" FROM pat GROUP BY 1, 2',
)
def _(lake: Lake):
    return d.age_statistics(lake.clean_patients(), "gender", "marital_status")


@query(
    "d07_age_box",
    """WITH q AS (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.5) AS median,
           quantile_cont(age, 0.75) AS q3 FROM (SELECT DISTINCT age FROM pat)),
         a AS (SELECT age, q1, median, q3,
           age BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
           FROM (SELECT DISTINCT age FROM pat), q)
       SELECT min(age) AS lowest, min(age) FILTER (inside) AS whisker_low,
         round(any_value(q1) + 1e-9, 4) AS q1, round(any_value(median) + 1e-9, 4) AS median,
         round(any_value(q3) + 1e-9, 4) AS q3, max(age) FILTER (inside) AS whisker_high,
         max(age) AS highest, count(*) FILTER (NOT inside) AS outliers FROM a""",
)
def _(lake: Lake):
    return d.age_box(lake.clean_patients())


# --- encounters -----------------------------------------------------------------------------------


@query(
    "d08_clean_encounters",
    """SELECT encounter_id, status, class_code, type_text,
         strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
         strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, patient_reference, service_provider_id,
         service_provider_display, participant_individual_display, participant_individual_reference,
         participant_period_start, participant_period_end, participant_type_code,
         participant_type_display, round(encounter_duration + 1e-9, 4) AS encounter_duration FROM enc""",
)
def _(lake: Lake):
    return lake.clean_encounters()


for column in ("class_code", "status"):
    query(f"d09_raw_{column}", f"SELECT DISTINCT {column} FROM encounter")(
        lambda lake, column=column: d.distinct_values(lake.table("encounter"), column)
    )
    query(f"d09_clean_{column}", f"SELECT DISTINCT {column} FROM enc")(
        lambda lake, column=column: d.distinct_values(lake.clean_encounters(), column)
    )


@query("d09_distinct_patients", "SELECT DISTINCT patient_reference FROM enc")
def _(lake: Lake):
    return d.distinct_values(lake.clean_encounters(), "patient_reference")


@query(
    "d09_number_of_patients", "SELECT count(DISTINCT patient_reference) AS patients FROM enc"
)
def _(lake: Lake):
    return d.distinct_count(lake.clean_encounters(), "patient_reference", "patients")


@query("d10_encounters_with_patients", f"SELECT {KNOWN} FROM ep")
def _(lake: Lake):
    return lake.known()


@query("d10_overlap", "SELECT count(*) AS overlap FROM ep")
def _(lake: Lake):
    return d.overlap(lake.clean_encounters(), lake.clean_patients())


@query(
    "d11_encounters_by_gender_and_class",
    'SELECT gender, class_code, count(*) AS "count" FROM ep GROUP BY 1, 2',
)
def _(lake: Lake):
    return d.encounter_counts(lake.totals(), "gender", "class_code")


def _pivot(column: str, values, cell: str) -> str:
    return ", ".join(f"{cell.format(v=v, c=column)} AS \"{v}\"" for v in values)


@query(
    "d11_class_by_gender",
    f"""SELECT gender, {_pivot('class_code', d.CLASSES, "count(*) FILTER ({c} = '{v}')")}
        FROM ep GROUP BY 1""",
)
def _(lake: Lake):
    return d.class_by_gender(lake.totals())


for key, number in (("gender", 12), ("age_group", 13)):
    query(
        f"d{number}_duration_by_{key}", f"SELECT {key}, {DURATION} AS avg_duration FROM ep GROUP BY 1"
    )(lambda lake, key=key: d.mean_durations(lake.totals(), key))


@query(
    "d14_longest_encounters",
    f"SELECT {KNOWN} FROM (SELECT * FROM ep ORDER BY encounter_duration DESC NULLS LAST, {TIES} LIMIT 10)",
)
def _(lake: Lake):
    return d.longest_encounters(lake.known())


@query(
    "d15_long_inpatient_stays",
    f"""SELECT {KNOWN} FROM (SELECT * FROM ep WHERE class_code = 'Inpatient'
          AND encounter_duration > 1440 ORDER BY encounter_duration DESC NULLS LAST, {TIES} LIMIT 10)""",
)
def _(lake: Lake):
    return d.longest_encounters(d.long_inpatient_stays(lake.known()))


@query(
    "d16_duration_by_class",
    f"""SELECT class_code, {DURATION} AS avg_duration,
          round(max(encounter_duration) + 1e-9, 4) AS max_duration FROM ep GROUP BY 1""",
)
def _(lake: Lake):
    return d.mean_and_longest(lake.totals(), "class_code")


@query("d17_without_outliers", f"SELECT {KNOWN} FROM fep")
def _(lake: Lake):
    return d.without_outliers(lake.known())


@query("d18_outliers", f"SELECT {KNOWN} FROM ep WHERE encounter_duration > 86400")
def _(lake: Lake):
    return d.outliers(lake.known())


MEANS = {
    "d19_usual_duration_by_class": ("class_code",),
    "d20_duration_by_class_and_age_group": ("class_code", "age_group"),
    "d21_duration_by_class_age_group_and_gender": ("class_code", "age_group", "gender"),
    "d22_duration_by_marital_status": ("marital_status",),
    "d23_duration_by_marital_status_and_gender": ("marital_status", "gender"),
    "d24_duration_by_marital_status_gender_and_age_group": ("marital_status", "gender", "age_group"),
}
for name, keys in MEANS.items():
    query(
        name,
        f"SELECT {', '.join(keys)}, {DURATION} AS avg_duration FROM fep GROUP BY ALL",
    )(lambda lake, keys=keys: d.mean_durations(lake.usual_totals(), *keys).orderBy(*keys))

EVERY = ("class_code", "age_group", "gender", "marital_status")


@query(
    "d19_to_d24_in_one_pass",
    " UNION ALL ".join(
        f"SELECT '{','.join(keys)}' AS \"keys\", "
        + ", ".join(k if k in keys else f"CAST(NULL AS VARCHAR) AS {k}" for k in EVERY)
        + f", {DURATION} AS avg_duration FROM fep GROUP BY ALL"
        for keys in MEANS.values()
    ),
)
def _(lake: Lake):
    return d.mean_durations_by_sets(lake.usual_totals(), list(MEANS.values()))


CELL = "coalesce(round(avg(encounter_duration) FILTER ({c} = '{v}') + 1e-9, 4), 0)"


@query(
    "d20_class_and_age_group_table",
    f"SELECT class_code, {_pivot('age_group', d.AGE_GROUPS, CELL)} FROM fep GROUP BY 1",
)
def _(lake: Lake):
    return d.duration_by_class_and_age_group(lake.usual_totals())


@query(
    "d21_class_age_group_and_gender_table",
    f"SELECT class_code, age_group, {_pivot('gender', codes.GENDERS, CELL)}, coalesce(round(avg(encounter_duration)"
    " FILTER (gender IS NULL OR NOT list_contains(['female', 'male', 'other', 'unknown'], gender)) + 1e-9, 4), 0)"
    f" AS {codes.UNLISTED} FROM fep GROUP BY 1, 2",
)
def _(lake: Lake):
    return d.duration_by_class_age_group_and_gender(lake.usual_totals())


# --- explanations of benefit ----------------------------------------------------------------------


@query("d25_number_of_benefits", "SELECT count(DISTINCT eob_id) AS benefits FROM eob")
def _(lake: Lake):
    return d.distinct_count(lake.eob(), "eob_id", "benefits")


def _sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE)"


@query(
    "d26_benefit_amounts",
    f"""SELECT round({_sum('total_amount')} / count(total_amount) + 1e-9, 4) AS avg_total_amount,
          round({_sum('payment_amount')} / count(payment_amount) + 1e-9, 4) AS avg_payment_amount,
          {_sum('total_amount')} AS total_claimed, {_sum('payment_amount')} AS total_paid FROM eob""",
    money=("total_claimed", "total_paid"),
)
def _(lake: Lake):
    return d.benefit_amounts(lake.eob())


@query(
    "d27_benefits_with_total",
    "SELECT round(total_amount + 1e-9, 4) AS total_amount FROM eob WHERE total_amount IS NOT NULL",
)
def _(lake: Lake):
    return d.with_total(lake.eob())


VALUE = "round(value_cents / 100.0 + 1e-9, 4) AS value"


@query(
    "d28_adjudication_lines",
    f"""SELECT eob_id, patient_reference, {VALUE}, currency, category_code, category_display FROM adj""",
)
def _(lake: Lake):
    return d.adjudication_lines(lake.eob())


@query(
    "d29_lines_with_claims",
    f"""SELECT adj.eob_id, adj.patient_reference, {VALUE}, adj.currency, category_display,
          billable_period_start, count(*) AS copies
        FROM adj JOIN eob ON adj.eob_id = eob.eob_id GROUP BY ALL""",
)
def _(lake: Lake):
    return lake.claim_lines()


@query(
    "d30_lines_with_demographics",
    f"""SELECT patient_reference, eob_id, {VALUE}, currency, category_display, billable_period_start,
          gender, age, marital_status, age_group, CAST(joined AS BIGINT) AS copies FROM adp""",
)
def _(lake: Lake):
    return lake.lines()


@query("d31_raw_categories", "SELECT DISTINCT category_display FROM adp")
def _(lake: Lake):
    return d.distinct_values(lake.lines(), "category_display")


@query(
    "d31_normalised_categories",
    """SELECT DISTINCT category_display, trim(lower(category_display)) AS category_display_normalized
       FROM adp""",
)
def _(lake: Lake):
    from pyspark.sql import functions as F

    folded = codes.folded(F.col("category_display")).alias("category_display_normalized")
    return lake.lines().select("category_display", folded).distinct()


@query("d31_category_labels", "SELECT DISTINCT category AS category_display FROM adr")
def _(lake: Lake):
    from pyspark.sql import functions as F

    label = codes.category_label(F.col("category_display")).alias("category_display")
    return lake.lines().select(label).distinct()


REPORTED = "category NOT IN ('Unknown', 'Part B Deductible')"


@query(
    "d32_reported_lines",
    f"""SELECT patient_reference, eob_id, {VALUE}, currency, category AS category_display,
          billable_period_start, gender, age, marital_status, age_group,
          CAST(joined AS BIGINT) AS copies FROM adr WHERE {REPORTED}""",
)
def _(lake: Lake):
    return d.reported_lines(lake.lines())


MEAN_VALUE = """round(CAST(sum(value_cents * joined) AS DOUBLE) / 100
  / sum(CASE WHEN value_cents IS NOT NULL THEN joined END) + 1e-9, 4)"""
VALUES = {
    "d33_value_by_category": (),
    "d34_value_by_category_and_gender": ("gender",),
    "d35_value_by_category_and_age_group": ("age_group",),
    "d36_value_by_category_and_demographics": ("gender", "age_group", "marital_status"),
}
for name, keys in VALUES.items():
    query(
        name,
        f"""SELECT {', '.join(('category AS category_display', *keys))}, {MEAN_VALUE} AS avg_value
            FROM adr WHERE {REPORTED} GROUP BY ALL""",
    )(
        lambda lake, keys=keys: d.mean_values(lake.category_totals(), *keys).orderBy(
            "category_display", *keys
        )
    )


@query(
    "d37_value_by_category_table",
    f"""SELECT gender, age_group, marital_status, {
        ", ".join(
            f"max(v) FILTER (category = '{c}') AS " + chr(34) + c + chr(34)
            for c in codes.REPORTED_CATEGORIES
        )
    } FROM (SELECT category, gender, age_group, marital_status, {MEAN_VALUE} AS v
            FROM adr WHERE {REPORTED} GROUP BY ALL) GROUP BY 1, 2, 3""",
)
def _(lake: Lake):
    return d.value_by_category(lake.category_totals())


def _daily(lake: Lake):
    """Sketches of the clean encounters by the day they start, kept as a table."""
    day = F.to_date("start_time")
    made = sketches.daily(
        lake.clean_encounters(), day, "class_code", distinct=["patient_reference"], numbers=["encounter_duration"]
    )
    return tables.kept(made, tables.shared_folder(lake.spark), f"daily-{uuid.uuid4().hex}")


@query(
    "a12_patients_from_daily_sketches",
    "SELECT class_code, count(DISTINCT patient_reference) AS patients, true AS close FROM enc GROUP BY class_code",
)
def _(lake: Lake):
    """The exact numbers, and whether the merged sketches of all days are within 3 % of them."""
    found = sketches.distinct_counts(_daily(lake), "patient_reference", "class_code", into="about")
    exact = lake.clean_encounters().select("class_code", "patient_reference").distinct()
    exact = exact.groupBy("class_code").agg(F.count("patient_reference").alias("patients"))
    close = F.abs(F.col("about") - F.col("patients")) <= 0.03 * F.col("patients")
    return exact.join(found, "class_code").select("class_code", "patients", close.alias("close"))


@query(
    "a17_duration_box_from_daily_sketches",
    """SELECT class_code, min(encounter_duration)::DOUBLE AS lowest, max(encounter_duration)::DOUBLE AS highest,
         true AS q1_close, true AS median_close, true AS q3_close FROM enc GROUP BY class_code""",
)
def _(lake: Lake):
    """The ends, and whether the share of values up to each quartile of the merged sketches is off by 3 % at most."""
    box = sketches.box_numbers(_daily(lake), "encounter_duration", "class_code")
    rows = lake.clean_encounters().select("class_code", "encounter_duration").join(F.broadcast(box), "class_code")
    x, shares = F.col("encounter_duration"), {"q1": 0.25, "median": 0.5, "q3": 0.75}
    judged = rows.groupBy("class_code", "lowest", "highest").agg(
        *(
            F.avg((x < F.col(n)).cast("double")).between(0, q + 0.03).alias(f"{n}_below")
            for n, q in shares.items()
        ),
        *(
            F.avg((x <= F.col(n)).cast("double")).between(q - 0.03, 1).alias(f"{n}_upto")
            for n, q in shares.items()
        ),
    )
    close = [(F.col(f"{n}_below") & F.col(f"{n}_upto")).alias(f"{n}_close") for n in shares]
    return judged.select("class_code", "lowest", "highest", *close)
