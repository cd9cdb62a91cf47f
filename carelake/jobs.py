"""Whole jobs, from input paths to Parquet results. `run_job.py` starts them:

    flatten                                 <bundles> <lake>
    flatten-lines                           <files with one resource a line> <lake>
    profile                                 <bundles> <results>
    cost | disparity | risk | readmission   <lake>    <results> [as_of]
    encounter-csv                           <file>    <results>

Paths are any URI the cluster reads, an object store included.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelake.operators import flatten, profile
from carelake.plans import cost, disparity, encounter_csv, features, models
from carelake.sources import bundles, tables


def flatten_job(spark: SparkSession, source: str, lake: str, partitions: int | None = None, lines: bool = False) -> None:
    """Bundles, or files with one resource a line, to the twelve flat tables, and the malformed documents to the table `rejected`. The
    documents are parsed once, into `<lake>/_entries`."""
    read = bundles.read_resources(spark, source) if lines else bundles.read_bundles(spark, source, partitions)
    staged = bundles.stage_entries(read, f"{lake}/_entries")
    for name, build in flatten.TABLES.items():
        tables.write_table(build(staged), lake, name)
    tables.write_table(bundles.rejected(staged), lake, bundles.REJECTED)


def profile_results(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    """What the fields of each resource type hold, declared in the schema or not, and the lists of all and of
    the informative fields of each type. The documents are read as text, once."""
    documents = spark.read.text(source, wholetext=True)
    found = profile.resource_profile(bundles.resource_texts(documents, F.col("value")))
    return {"fields": found, "field_lists": profile.column_lists(found, "resource_type")}


def cost_results(spark: SparkSession, lake: str, results: str, as_of: str) -> dict[str, DataFrame]:
    patient, encounter, claim, procedure = (
        tables.read_table(spark, lake, n) for n in ("patient", "encounter", "claim", "procedure")
    )
    patients, encounters = cost.patient_view(patient), cost.encounter_view(encounter)
    claims, procedures = cost.claim_view(claim), cost.procedure_view(procedure)
    costliest = tables.kept(cost.costliest_claims(claims, encounters), results, "_costliest")
    by_procedure = cost.cost_by_procedure(procedures, claims, encounters)
    by_procedure = tables.kept(by_procedure, results, "_by_procedure")
    return {
        "costliest_claims": costliest,
        "mean_of_costliest_by_type": cost.mean_of_costliest(costliest),
        "cost_by_encounter_type": cost.cost_by_encounter_type(claims, encounters),
        "cost_by_provider": cost.cost_by_provider(claims, encounters),
        "cost_by_gender": cost.cost_by_gender(claims, patients),
        "cost_by_age_range": cost.cost_by_age_range(claims, patients, as_of),
        "cost_by_procedure": by_procedure,
        "costliest_procedures": cost.costliest_procedures(by_procedure),
    }


def disparity_results(
    spark: SparkSession, lake: str, results: str, as_of: str
) -> dict[str, DataFrame]:
    d = disparity
    patient, encounter, eob = (
        tables.read_table(spark, lake, n)
        for n in ("patient", "encounter", "explanation_of_benefit")
    )
    patients, encounters = d.clean_patients(patient, as_of), d.clean_encounters(encounter)
    usual = d.without_outliers(encounters)
    known = d.encounters_with_patients(encounters, patients)
    totals = tables.kept(d.encounter_totals(encounters, patients), results, "_totals")
    usual_totals = tables.kept(d.encounter_totals(usual, patients), results, "_usual_totals")
    weights = d.patient_weights(usual, patients)
    amounts = tables.kept(d.category_totals(eob, weights), results, "_category_totals")
    marital = ("marital_status", "gender", "age_group")
    return {
        "number_of_cities": d.distinct_count(patient, "city", "cities"),
        "missing_ids": d.missing_ids(patients),
        "patients_by_gender": d.counts_by(patients, "gender"),
        "patients_by_age": d.counts_by(patients, "age"),
        "patients_by_marital_status": d.counts_by(patients, "marital_status"),
        "age": d.age_statistics(patients),
        "age_by_gender_and_marital_status": d.age_statistics(patients, "gender", "marital_status"),
        "age_box": d.age_box(patients),
        "overlap": d.overlap(encounters, patients),
        "class_by_gender": d.class_by_gender(totals),
        "duration_by_gender": d.mean_durations(totals, "gender"),
        "duration_by_age_group": d.mean_durations(totals, "age_group"),
        "longest_encounters": d.longest_encounters(known),
        "long_inpatient_stays": d.longest_encounters(d.long_inpatient_stays(known)),
        "duration_by_class": d.mean_and_longest(totals, "class_code"),
        "outliers": d.outliers(known),
        "usual_durations": d.mean_durations_by_sets(
            usual_totals,
            [
                ("class_code",),
                ("class_code", "age_group"),
                ("class_code", "age_group", "gender"),
                *(marital[:n] for n in (1, 2, 3)),
            ],
        ),
        "class_and_age_group_table": d.duration_by_class_and_age_group(usual_totals),
        "class_age_group_and_gender_table": d.duration_by_class_age_group_and_gender(usual_totals),
        "number_of_benefits": d.distinct_count(eob, "eob_id", "benefits"),
        "benefit_amounts": d.benefit_amounts(eob),
        "value_by_category": d.mean_values(amounts),
        "value_by_category_and_gender": d.mean_values(amounts, "gender"),
        "value_by_category_and_age_group": d.mean_values(amounts, "age_group"),
        "value_by_category_and_demographics": d.mean_values(
            amounts, "gender", "age_group", "marital_status"
        ),
        "value_by_category_table": d.value_by_category(amounts),
    }


def csv_results(
    spark: SparkSession,
    source: str,
    results: str,
    schema: str | None = None,
    year: int = encounter_csv.DEFAULT_AS_OF,
) -> dict[str, DataFrame]:
    """The reports by title, ages counted to `year`. The file is parsed once, into Parquet; with a
    `schema` the pass that infers types is left out."""
    rows = tables.kept(tables.read_encounter_csv(spark, source, schema), results, "_rows")
    return encounter_csv.all_reports(rows, year)


def _feature_rows(spark: SparkSession, lake: str, results: str, as_of: str, span: bool) -> DataFrame:
    sources = {
        n: tables.read_table(spark, lake, n)
        for n in (
            "patient",
            "encounter",
            "claim",
            "condition",
            "procedure",
            "immunization",
            "diagnostic_report",
        )
    }
    return tables.kept(features.feature_table(sources, as_of, span=span), results, "features")


def risk_results(
    spark: SparkSession,
    lake: str,
    results: str,
    as_of: str,
    trees: int = 100,
    rounds: int = 1000,
    folds: int = models.FOLDS,
    grid: dict = models.GRID,
) -> dict[str, DataFrame]:
    """Forest and boosted risk scores of five held-out patients with their errors, the forest's
    cross-validated error, and the parameter search of the forest with the scores of its best point."""
    train, test = models.hold_out_rows(_feature_rows(spark, lake, results, as_of, span=False))
    regressor = models.risk_forest(numTrees=trees)
    forest = models.pipeline(regressor)
    boosted = models.risk_boosted_scores(train, test, f"{results}/_boosting", rounds=rounds)
    boosted = tables.kept(boosted, results, "_boosted")
    found = models.searched(regressor, train, f"{results}/_search", grid, folds)
    return {
        **_scored({"forest": forest.fit(train), "searched": found.model}, test),
        "boosting_scores": boosted,
        "boosting_metrics": models.metrics(boosted),
        "forest_cross_validation": _errors(spark, models.cross_validated(forest, train, folds=folds)),
        "search_points": _points(found),
    }


def readmission_results(
    spark: SparkSession,
    lake: str,
    results: str,
    as_of: str,
    trees: int = 100,
    rounds: int = 100,
    folds: int = models.FOLDS,
    grid: dict = models.GRID,
) -> dict[str, DataFrame]:
    """As `risk_results`, for a share of the patients; boosting is cross-validated too."""
    rows = _feature_rows(spark, lake, results, as_of, span=True)
    train, test = models.hold_out_share(rows)
    regressor = models.readmission_forest(numTrees=trees)
    forest = models.pipeline(regressor)
    boosting = models.pipeline(models.readmission_boosting(maxIter=rounds))
    found = models.searched(regressor, train, f"{results}/_search", grid, folds)
    fitted = {"forest": forest.fit(train), "boosting": boosting.fit(train), "searched": found.model}
    checked = {"forest": forest, "boosting": boosting}
    return {
        **_scored(fitted, test),
        **{
            f"{name}_cross_validation": _errors(spark, models.cross_validated(e, train, folds=folds))
            for name, e in checked.items()
        },
        "search_points": _points(found),
    }


def _points(found: models.Search) -> DataFrame:
    """As `_errors`, for a search."""
    points = found.points()
    names = sorted(found.best)
    text = F.concat_ws(", ", *(F.concat(F.lit(f"{n}="), F.col(n).cast("string")) for n in names))
    best = F.lit(True)
    for n in names:
        best = best & (F.col(n) == F.lit(found.best[n]))
    return points.select(text.alias("parameters"), "mse", best.alias("best"))


def _errors(spark: SparkSession, found) -> DataFrame:
    """The mean squared error of each point of a validation, its parameters as text, the best one marked."""
    errors = [float(mse) for mse in found.avgMetrics]
    best = min(errors)
    points = [
        (", ".join(sorted(f"{p.name}={v}" for p, v in point.items())), mse, mse == best)
        for point, mse in zip(found.getEstimatorParamMaps(), errors)
    ]
    return spark.createDataFrame(points, "parameters string, mse double, best boolean")


def _scored(fitted: dict, test: DataFrame) -> dict[str, DataFrame]:
    out = {}
    for name, model in fitted.items():
        out[f"{name}_scores"] = models.scores(model, test)
        out[f"{name}_metrics"] = models.metrics(out[f"{name}_scores"])
    return out


def _directory(title: str) -> str:
    return "_".join(title.lower().replace(".", "").split())


JOBS = ("flatten", "flatten-lines", "profile", "cost", "disparity", "risk", "readmission", "encounter-csv")


def main(job: str, source: str, target: str, as_of: str | None = None) -> None:
    if job not in JOBS:
        raise SystemExit(__doc__)
    as_of = as_of or date.today().isoformat()
    spark = tables.session(f"carelake {job}")
    if job in ("flatten", "flatten-lines"):
        flatten_job(spark, source, target, lines=job == "flatten-lines")
        return
    if job == "profile":
        results = profile_results(spark, source)
        results["fields"] = tables.kept(results["fields"], target, "fields")
        tables.write_table(profile.column_lists(results["fields"], "resource_type"), target, "field_lists")
        return
    if job == "encounter-csv":
        results = {_directory(t): r for t, r in csv_results(spark, source, target).items()}
    elif job == "cost":
        results = cost_results(spark, source, target, as_of)
    elif job == "disparity":
        results = disparity_results(spark, source, target, as_of)
    elif job == "risk":
        results = risk_results(spark, source, target, as_of)
    else:
        results = readmission_results(spark, source, target, as_of)
    tables.write_results(results, target)
