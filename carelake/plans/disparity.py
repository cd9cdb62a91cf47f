"""Demographic-disparity reports on patients, encounters and explanations of benefit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from carelake.functions import codes
from carelake.operators.joins import counted, mean_of
from carelake.operators.shapes import box_numbers, cells, top

# Minutes. 60 days, and one day.
LONGEST_STAY = 86400
LONG_STAY = 1440

# Columns of the encounter table that the reports leave out.
CARE_GIVER_COLUMNS = (
    "service_provider_id",
    "service_provider_display",
    "participant_individual_display",
    "participant_individual_reference",
    "participant_period_start",
    "participant_period_end",
    "participant_type_code",
    "participant_type_display",
)
ENCOUNTER_TIES = ("encounter_id", "class_code", "status", "type_text", "start_time", "patient_id")
DEMOGRAPHICS = ("gender", "age", "marital_status", "age_group")
CLASSES = (*codes.CLASS_LABELS.values(), codes.UNKNOWN)
AGE_GROUPS = (*(name for _, name in codes.AGE_GROUPS), codes.AGE_GROUP_REST)


# --- patients -------------------------------------------------------------------------------------


def clean_patients(patient: DataFrame, as_of: str) -> DataFrame:
    return patient.select(
        "patient_id",
        "gender",
        "birth_date",
        "state",
        "postal_code",
        codes.marital_label(F.col("marital_status")).alias("marital_status"),
        "disability_adjusted_life_years",
        "quality_adjusted_life_years",
        codes.age_by_year(F.col("birth_date"), as_of).alias("age"),
    )


def distinct_values(table: DataFrame, *columns: str) -> DataFrame:
    return table.select(*columns).distinct()


def distinct_count(table: DataFrame, column: str, into: str) -> DataFrame:
    """Number of distinct values, counting NULL as one, in two steps of partial aggregation."""
    return table.select(column).distinct().agg(F.count("*").alias(into))


def approx_distinct_count(table: DataFrame, column: str, into: str, rsd: float = 0.02) -> DataFrame:
    """Sketch of the same; one small row per task and no shuffle of values. NULL is not counted."""
    return table.agg(F.approx_count_distinct(column, rsd).alias(into))


def missing_ids(patients: DataFrame) -> DataFrame:
    return patients.agg(F.count_if(F.col("patient_id").isNull()).alias("missing"))


def counts_by(table: DataFrame, *keys: str) -> DataFrame:
    return counted(table, *keys, into="count")


def age_statistics(patients: DataFrame, *keys: str) -> DataFrame:
    """Mean and sample deviation of age; with keys also the number of patients."""
    statistics = [F.avg("age").alias("average_age"), F.stddev_samp("age").alias("stddev_age")]
    if not keys:
        return patients.agg(*statistics)
    return patients.groupBy(*keys).agg(*statistics, F.count("*").alias("count"))


def age_box(patients: DataFrame) -> DataFrame:
    """Box-plot numbers of the ages that occur, each counted once."""
    return box_numbers(distinct_values(patients.filter("age is not null"), "age"), "age")


# --- encounters -----------------------------------------------------------------------------------


def clean_encounters(encounter: DataFrame) -> DataFrame:
    start, end = (F.try_to_timestamp(c) for c in ("start_time", "end_time"))
    return (
        encounter.dropna(subset=["encounter_id", "patient_reference", "start_time"])
        .withColumns({"start_time": start, "end_time": end})
        .withColumns(
            {
                "encounter_duration": codes.minutes_between(F.col("start_time"), F.col("end_time")),
                "status": codes.status_label(F.col("status")),
                "class_code": codes.class_label(F.col("class_code")),
                "patient_reference": codes.bare_key(F.col("patient_reference")),
            }
        )
    )


def without_outliers(encounters: DataFrame) -> DataFrame:
    """Leave out inpatient stays of more than 60 days, and those of unknown length."""
    usual = F.col("encounter_duration") <= LONGEST_STAY
    return encounters.filter(usual | (F.col("class_code") != "Inpatient"))


def outliers(encounters: DataFrame) -> DataFrame:
    return encounters.filter(F.col("encounter_duration") > LONGEST_STAY)


def long_inpatient_stays(encounters: DataFrame) -> DataFrame:
    long = F.col("encounter_duration") > LONG_STAY
    return encounters.filter(long & (F.col("class_code") == "Inpatient"))


def encounters_with_patients(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Encounters of known patients with their demographics, without the care givers. A patient with
    very many encounters is one key; adaptive execution splits its partition."""
    known = encounters.drop(*CARE_GIVER_COLUMNS).join(
        patients, encounters["patient_reference"] == patients["patient_id"]
    )
    return known.withColumn("age_group", codes.age_group(F.col("age")))


def overlap(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Number of rows of that join."""
    rows = counted(encounters, "patient_reference", into="n")
    met = rows.join(
        patients.select("patient_id"), F.col("patient_reference") == F.col("patient_id")
    )
    return met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("overlap"))


def longest_encounters(known: DataFrame, k: int = 10) -> DataFrame:
    return top(known, k, "encounter_duration", *ENCOUNTER_TIES)


def encounter_totals(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """What all reports on counts and durations are summed from: one row per patient and class.

    Encounters are reduced before they meet the patients, so the shuffle carries totals, and a patient
    with a third of all encounters is a handful of rows in it.
    """
    minutes = F.col("encounter_duration")
    totals = encounters.groupBy("patient_reference", "class_code").agg(
        F.count("*").alias("encounters"),
        F.count(minutes).alias("timed"),
        F.sum(minutes).alias("minutes"),
        F.max(minutes).alias("longest"),
    )
    people = patients.select(
        "patient_id",
        "gender",
        "marital_status",
        codes.age_group(F.col("age")).alias("age_group"),
    )
    return totals.join(people, totals["patient_reference"] == people["patient_id"])


def encounter_counts(totals: DataFrame, *keys: str) -> DataFrame:
    return totals.groupBy(*keys).agg(F.sum("encounters").alias("count"))


def mean_durations(totals: DataFrame, *keys: str) -> DataFrame:
    return totals.groupBy(*keys).agg(
        mean_of(F.sum("minutes"), F.sum("timed")).alias("avg_duration")
    )


def mean_durations_by_sets(totals: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """`mean_durations` for several key sets in one pass over the totals. `keys` names the set of a
    row; columns outside of it are NULL."""
    every = list(dict.fromkeys(k for keys in sets for k in keys))
    names = F.create_map(
        *(
            F.lit(x)
            for keys in sets
            for x in (_set_number(every, keys), ",".join(keys))
        )
    )
    grouped = totals.groupingSets([[F.col(k) for k in keys] for keys in sets], *every).agg(
        names[F.grouping_id()].alias("keys"),
        mean_of(F.sum("minutes"), F.sum("timed")).alias("avg_duration"),
    )
    return grouped.select("keys", *every, "avg_duration")


def _set_number(every: Sequence[str], keys: Sequence[str]) -> int:
    """grouping_id of a set: a bit per column, set where the column is left out."""
    bits = "".join("0" if k in keys else "1" for k in every)
    return int(bits, 2)


def mean_and_longest(totals: DataFrame, *keys: str) -> DataFrame:
    return totals.groupBy(*keys).agg(
        mean_of(F.sum("minutes"), F.sum("timed")).alias("avg_duration"),
        F.max("longest").alias("max_duration"),
    )


def class_by_gender(totals: DataFrame) -> DataFrame:
    counts = encounter_counts(totals, "gender", "class_code")
    return cells(counts, ["gender"], "class_code", CLASSES, F.col("count"), fill=0)


def duration_by_class_and_age_group(totals: DataFrame) -> DataFrame:
    means = mean_durations(totals, "class_code", "age_group")
    return cells(means, ["class_code"], "age_group", AGE_GROUPS, F.col("avg_duration"), fill=0.0)


def duration_by_class_age_group_and_gender(
    totals: DataFrame, genders: Sequence[str] = codes.GENDERS
) -> DataFrame:
    """A column for each of `genders`, and one for all others and NULL together."""
    listed = F.when(F.col("gender").isin(*genders), F.col("gender")).otherwise(codes.UNLISTED)
    means = mean_durations(totals.withColumn("gender", listed), "class_code", "age_group", "gender")
    rows, columns = ["class_code", "age_group"], [*genders, codes.UNLISTED]
    return cells(means, rows, "gender", columns, F.col("avg_duration"), fill=0.0)


# --- explanations of benefit ----------------------------------------------------------------------


def benefit_amounts(eob: DataFrame) -> DataFrame:
    return eob.agg(
        F.avg("total_amount").alias("avg_total_amount"),
        F.avg("payment_amount").alias("avg_payment_amount"),
        F.sum("total_amount").alias("total_claimed"),
        F.sum("payment_amount").alias("total_paid"),
    )


def with_total(eob: DataFrame) -> DataFrame:
    return eob.filter(F.col("total_amount").isNotNull()).select("total_amount")


def _line(line: Column) -> Column:
    """What the reports read of an adjudication line: the amount and the first coding."""
    coding = F.get(line["category"]["coding"], F.lit(0))
    return F.struct(
        line["amount"]["value"].alias("value"),
        line["amount"]["currency"].alias("currency"),
        coding["code"].alias("category_code"),
        coding["display"].alias("category_display"),
    )


def adjudication_lines(eob: DataFrame, *others: str) -> DataFrame:
    """One row per adjudication line of a benefit row, with the amount and the first coding; `others` are
    further columns of the row to go with each line."""
    lines = eob.select("eob_id", "patient_reference", *others, F.explode("adjudication").alias("line"))
    return lines.select("eob_id", "patient_reference", *others, _line(F.col("line")).alias("l")).select(
        "eob_id", "patient_reference", "l.*", *others
    )


LINE = ("eob_id", "patient_reference", "value", "currency", "category_display")


def lines_with_claims(lines: DataFrame, eob: DataFrame) -> DataFrame:
    """Join of the lines with the benefit rows of the same id. Rows that join alike are one row:
    `copies` of them are meant.

    Neither side is broadcast: how many lines there are is not seen in the size of the table.
    """
    left = counted(lines, *LINE, into="line_rows")
    right = counted(eob, "eob_id", "billable_period_start", into="eob_rows")
    return left.join(right.hint("merge"), "eob_id").select(
        *LINE, "billable_period_start", (F.col("line_rows") * F.col("eob_rows")).alias("copies")
    )


def claim_lines(eob: DataFrame) -> DataFrame:
    """`lines_with_claims` of all lines of the benefit rows, for which the rows are shuffled once, by their id,
    with their lines still in one array. Counting and joining by the id, and counting of the lines, need
    no further shuffle of them."""
    with_lines = eob.filter("eob_id is not null").select("eob_id", "patient_reference", "adjudication")
    with_lines = with_lines.repartition("eob_id").filter("size(adjudication) > 0")
    rows = counted(with_lines, "eob_id", "patient_reference", "adjudication", into="line_rows")
    claims = counted(eob, "eob_id", "billable_period_start", into="eob_rows")
    met = rows.join(claims.hint("merge"), "eob_id")
    lines = adjudication_lines(met, "billable_period_start", "line_rows", "eob_rows")
    copies = F.sum(F.col("line_rows") * F.col("eob_rows"))
    return lines.groupBy(*LINE, "billable_period_start").agg(copies.alias("copies"))


def patient_weights(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Demographics per patient with the number of encounter rows they would be repeated in."""
    rows = counted(encounters, "patient_reference", into="encounter_rows")
    people = patients.select(
        "patient_id",
        "gender",
        "age",
        "marital_status",
        codes.age_group(F.col("age")).alias("age_group"),
    )
    met = rows.join(people, rows["patient_reference"] == people["patient_id"])
    return met.select("patient_reference", *DEMOGRAPHICS, "encounter_rows")


def lines_with_demographics(claim_lines: DataFrame, weights: DataFrame) -> DataFrame:
    """Join of the lines with the encounter rows of the patient, `copies` as above. Neither side is broadcast."""
    bare = claim_lines.withColumn("patient_reference", codes.bare_key(F.col("patient_reference")))
    return (
        bare.join(weights.hint("merge"), "patient_reference")
        .withColumn("copies", F.col("copies") * F.col("encounter_rows"))
        .drop("encounter_rows")
    )


def reported_lines(lines: DataFrame) -> DataFrame:
    """Lines under their category label, without the categories that are not reported."""
    label = codes.category_label(F.col("category_display"))
    labelled = lines.withColumn("category_display", label)
    return labelled.filter(~F.col("category_display").isin(*codes.UNREPORTED_CATEGORIES))


def category_totals(eob: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted sums of the reported lines per category and patient, with the demographics: what the
    reports on amounts are summed from.

    One pass over the benefits: the first line of a row, or its absence, counts the row, so that lines
    that are not reported stay, without a category, until the rows of their benefit are counted. Lines
    are summed per benefit before the first shuffle, then per patient, and only then meet the
    demographics.
    """
    lines = eob.filter("eob_id is not null").select(
        "eob_id",
        codes.bare_key(F.col("patient_reference")).alias("patient_reference"),
        F.posexplode_outer("adjudication").alias("place", "line"),
    )
    coding = F.get(F.col("line.category.coding"), F.lit(0))
    label = codes.category_label(coding["display"])
    by_benefit = (
        lines.withColumns(
            {
                "category_display": F.when(~label.isin(*codes.UNREPORTED_CATEGORIES), label),
                "value": F.col("line.amount.value"),
                "opens": F.coalesce("place", F.lit(0)) == 0,
            }
        )
        .groupBy("eob_id", "patient_reference", "category_display")
        .agg(F.sum("value").alias("amount"), F.count("value").alias("amounts"), F.count_if("opens").alias("rows"))
    )
    n = F.col("eob_rows")
    by_patient = (
        by_benefit.withColumn("eob_rows", F.sum("rows").over(Window.partitionBy("eob_id")))
        .filter("category_display is not null")
        .groupBy("patient_reference", "category_display")
        .agg(F.sum(F.col("amount") * n).alias("amount"), F.sum(F.col("amounts") * n).alias("amounts"))
    )
    m = F.col("encounter_rows")
    return by_patient.join(weights, "patient_reference").select(
        "category_display",
        *DEMOGRAPHICS,
        (F.col("amount") * m).alias("amount"),
        (F.col("amounts") * m).alias("amounts"),
    )


def mean_values(totals: DataFrame, *keys: str) -> DataFrame:
    """Mean amount per category and further keys."""
    return totals.groupBy("category_display", *keys).agg(
        mean_of(F.sum("amount"), F.sum("amounts")).alias("avg_value")
    )


def value_by_category(totals: DataFrame) -> DataFrame:
    """Rows gender, age group, marital status; a column per category."""
    rows = ["gender", "age_group", "marital_status"]
    means = mean_values(totals, *rows)
    return cells(means, rows, "category_display", codes.REPORTED_CATEGORIES, F.col("avg_value"))
