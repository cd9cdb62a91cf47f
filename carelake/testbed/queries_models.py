"""Checked queries: features and models. Scores have no SQL form; they are checked in the tests."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from carelake.plans import features, models, trees
from carelake.sources import tables
from carelake.testbed import star
from carelake.testbed.book import Lake, query

FEATURE_TABLES = (
    "patient encounter claim condition procedure immunization diagnostic_report".split()
)
COUNTS = (
    "num_encounters, completed_encounters, num_claims, total_claim_amount, num_conditions,"
    " num_procedures, num_immunizations, num_diagnostic_reports"
)
BASE = (
    "patient_id, state, has_chronic_conditions, total_healthcare_cost, age, is_senior,"
    " round(region_risk + 1e-9, 4) AS region_risk, label"
)
MONEY = ("total_healthcare_cost", "total_claim_amount")


def _features(lake: Lake, span: bool = False):
    sources = {name: lake.table(name) for name in FEATURE_TABLES}
    return features.feature_table(sources, star.AS_OF, span=span)


def _settled(rows):
    """The features as a table, as the jobs keep them: fitting passes over them many times."""
    return tables.kept(rows, tables.shared_folder(rows.sparkSession), f"features-{uuid.uuid4().hex}")


def _folder(lake: Lake, name: str) -> str:
    return f"{tables.shared_folder(lake.spark)}/{name}-{uuid.uuid4().hex}"


@query("m01_chronic_flag", "SELECT patient_id, has_chronic_conditions FROM feat")
def _(lake: Lake):
    flagged = features.with_chronic_flag(lake.table("patient"), lake.table("condition"))
    return flagged.select("patient_id", "has_chronic_conditions")


@query("m02_healthcare_cost", "SELECT patient_id, total_healthcare_cost FROM feat", money=MONEY)
def _(lake: Lake):
    costed = features.with_healthcare_cost(lake.table("patient"), lake.table("claim"))
    return costed.select("patient_id", "total_healthcare_cost")


@query(
    "m03_derived_features",
    "SELECT patient_id, age, is_senior, round(region_risk + 1e-9, 4) AS region_risk, label FROM feat",
)
def _(lake: Lake):
    derived = features.with_derived(lake.table("patient"), star.AS_OF)
    return derived.select("patient_id", "age", "is_senior", "region_risk", "label")


@query("m04_patient_features", f"SELECT {BASE} FROM feat", money=MONEY)
def _(lake: Lake):
    return features.patient_features(
        lake.table("patient"), lake.table("condition"), lake.table("claim"), star.AS_OF
    )


PARTS = {
    "m05_encounter_features": (
        features.encounter_features,
        "encounter",
        "num_encounters, completed_encounters, first_encounter, last_encounter",
        "num_encounters",
    ),
    "m06_claim_features": (
        features.claim_features,
        "claim",
        "num_claims, total_claim_amount",
        "num_claims",
    ),
    "m07_condition_features": (
        features.condition_features,
        "condition",
        "num_conditions, has_chronic_conditions",
        "num_conditions",
    ),
    "m08_procedure_features": (
        features.procedure_features,
        "procedure",
        "num_procedures",
        "num_procedures",
    ),
    "m09_immunization_features": (
        features.immunization_features,
        "immunization",
        "num_immunizations",
        "num_immunizations",
    ),
    "m10_diagnostic_features": (
        features.diagnostic_features,
        "diagnostic_report",
        "num_diagnostic_reports",
        "num_diagnostic_reports",
    ),
}
for name, (build, table, columns, present) in PARTS.items():
    query(name, f"SELECT patient_id, {columns} FROM feat WHERE {present} > 0", money=MONEY)(
        lambda lake, build=build, table=table: build(lake.table(table))
    )


@query("m11_risk_features", f"SELECT {BASE}, {COUNTS} FROM feat", money=MONEY)
def _(lake: Lake):
    return _features(lake)


@query(
    "m12_readmission_features",
    f"SELECT {BASE}, {COUNTS}, first_encounter, last_encounter FROM feat",
    money=MONEY,
)
def _(lake: Lake):
    return _features(lake, span=True)


@query(
    "m13_hold_out_share",
    """SELECT patient_id, substr(md5('42:' || patient_id), 1, 8) < '33333333' AS held FROM patient""",
)
def _(lake: Lake):
    train, test = models.hold_out_share(lake.table("patient").select("patient_id"))
    return train.withColumn("held", F.lit(False)).unionByName(test.withColumn("held", F.lit(True)))


@query(
    "m13_hold_out_rows",
    "SELECT patient_id FROM patient ORDER BY md5('42:' || patient_id) LIMIT 5",
)
def _(lake: Lake):
    return models.hold_out_rows(lake.table("patient").select("patient_id"))[1]


def _scaled(column: str) -> str:
    return (
        f"coalesce(round(({column} - avg({column}) OVER ()) / nullif(stddev_samp({column}) OVER (), 0)"
        f" + 1e-9, 4), 0) AS {column}"
    )


@query(
    "m14_scaled_numbers",
    f"SELECT patient_id, {', '.join(_scaled(c) for c in models.NUMERIC)} FROM feat",
)
def _(lake: Lake):
    rows = _settled(_features(lake))
    scaled = Pipeline(stages=models.numeric_stages()).fit(rows).transform(rows)
    numbers = scaled.select("patient_id", vector_to_array("numeric").alias("n"))
    return numbers.select(
        "patient_id", *(F.col("n")[i].alias(c) for i, c in enumerate(models.NUMERIC))
    )


@query(
    "m15_coded_categories",
    """WITH n AS (SELECT state, row_number() OVER (ORDER BY count(*) DESC, state) - 1 AS place
                  FROM feat GROUP BY state)
       SELECT patient_id, place AS state_place FROM feat JOIN n ON feat.state = n.state""",
)
def _(lake: Lake):
    rows = lake.table("patient").select("patient_id", "state")
    coded = Pipeline(stages=models.categorical_stages(["state"])).fit(rows).transform(rows)
    # The 0/1 columns are in order of frequency: the place of the 1.
    place = F.array_position(vector_to_array("state_coded"), F.lit(1.0)) - 1
    return coded.select("patient_id", place.alias("state_place"))


@query(
    "m19_state_codes",
    """SELECT patient_id, dense_rank() OVER (ORDER BY state) - 1 AS state_code FROM patient""",
)
def _(lake: Lake):
    rows = lake.table("patient").select("patient_id", "state")
    numbered = models.state_codes(*models.hold_out_share(rows)).transform(rows)
    return numbered.select("patient_id", F.col("state_code").cast("long").alias("state_code"))


@query(
    "m23_metrics_of_a_fixed_score",
    """SELECT round(avg(e) + 1e-9, 4) AS mse, round(1 - avg(e) / var_pop(label) + 1e-9, 4) AS r2
       FROM (SELECT label, (label - age / 100.0::DOUBLE) * (label - age / 100.0::DOUBLE) AS e FROM feat)""",
)
def _(lake: Lake):
    scored = _features(lake).select("label", (F.col("age") / 100.0).alias("prediction"))
    return models.metrics(scored)


@query(
    "m24_folds",
    """SELECT patient_id, ('0x' || substr(md5('43:' || patient_id), 1, 8))::BIGINT % 5 AS fold FROM patient""",
)
def _(lake: Lake):
    return models.with_fold(lake.table("patient").select("patient_id"))


# --- models: no SQL --------------------------------------------------------------------------------
# All have the full numbers of rounds, trees, levels, points and folds that `models` documents, on all rows.


def _split(lake: Lake):
    rows = _settled(_features(lake))
    return rows, *models.hold_out_share(rows)


@query("m17_forest_scores")
def _(lake: Lake):
    rows = _settled(_features(lake))
    train, test = models.hold_out_rows(rows)
    return models.scores(models.pipeline(models.risk_forest()).fit(train), test)


@query("m18_readmission_forest_scores")
def _(lake: Lake):
    _, train, test = _split(lake)
    forest = models.readmission_forest()
    return models.scores(models.pipeline(forest).fit(train), test)


@query("m20_boosting_scores")
def _(lake: Lake):
    rows = _settled(_features(lake))
    train, test = models.hold_out_rows(rows)
    return models.risk_boosted_scores(train, test, _folder(lake, "boosting"))


@query("m21_readmission_boosting_scores")
def _(lake: Lake):
    _, train, test = _split(lake)
    boosting = models.readmission_boosting()
    return models.scores(models.pipeline(boosting).fit(train), test)


@query("m23_metrics")
def _(lake: Lake):
    _, train, test = _split(lake)
    forest = models.readmission_forest()
    return models.metrics(models.scores(models.pipeline(forest).fit(train), test))


@query("m24_cross_validated_mse")
def _(lake: Lake):
    rows, _, _ = _split(lake)
    estimator = models.pipeline(models.readmission_forest())
    found = models.cross_validated(estimator, rows)
    scored = models.scores(found, rows)
    return models.metrics(scored).select(
        F.lit(found.avgMetrics[0]).alias("cross_validated_mse"), F.col("mse").alias("refit_mse")
    )


@query("m25_grid_search")
def _(lake: Lake):
    _, train, test = _split(lake)
    found = models.searched(models.readmission_forest(), train, _folder(lake, "search"))
    return models.metrics(models.scores(found.model, test)).select(
        *(F.lit(str(v)).alias(f"best_{k}") for k, v in found.best.items()), "mse", "r2"
    )


@query(
    "m17_scores_from_nodes",
    "SELECT patient_id, true AS same FROM feat WHERE substr(md5('42:' || patient_id), 1, 8) < '33333333'",
)
def _(lake: Lake):
    """The forest's own scores against those from its table of nodes."""
    _, train, test = _split(lake)
    fitted = models.pipeline(models.risk_forest()).fit(train)
    nodes = trees.nodes_of(fitted.stages[-1], _folder(lake, "forest"))
    scored = fitted.transform(test).withColumnRenamed("prediction", "own")
    scored = trees.forest_scores(scored, nodes, vector_to_array("features"), models.RISK_DEPTH)
    return scored.select("patient_id", (F.abs(F.col("own") - F.col("prediction")) < 1e-9).alias("same"))
