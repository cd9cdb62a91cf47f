"""The encounter file, named results and the whole jobs."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carelake import jobs
from carelake.plans import encounter_csv as reports
from carelake.sources import tables
from carelake.testbed import star

AS_OF = "2024-12-01"


@pytest.fixture(scope="module")
def csv_file(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "encounters")
    star.encounter_csv(spark, sf_dir).write.csv(path, header=True)
    return path


def test_csv_types(spark, sf_dir, csv_file):
    read = tables.read_encounter_csv(spark, csv_file)
    made = star.encounter_csv(spark, sf_dir)
    assert read.columns == made.columns
    assert dict(read.dtypes)["BIRTHDATE"] == "date"
    assert dict(read.dtypes)["ENCOUNTER_BASE_COST"] == "double"
    declared = tables.read_encounter_csv(spark, csv_file, schema=made.schema)
    assert rows(declared) == rows(made)


def test_csv_reports_from_the_file(spark, sf_dir, csv_file, tmp_path):
    results = jobs.csv_results(spark, csv_file, str(tmp_path))
    assert list(results) == list(reports.REPORTS) and len(results) == 18
    made = reports.all_reports(star.encounter_csv(spark, sf_dir))
    for title in ("Age Distribution", "Average Encounter Costs", "Most Frequent Procedures", "Frequent Encounter Reasons"):
        assert rows(results[title]) == rows(made[title]), title
    tables.write_results({"a b": results["Age Distribution"]}, str(tmp_path))
    assert rows(tables.read_table(spark, str(tmp_path), "a b")) == rows(made["Age Distribution"])


def test_age_year_is_a_parameter(spark):
    df = spark.sql("select date'2000-05-05' BIRTHDATE")
    assert reports.with_age(df).first().Age == 23 and reports.with_age(df, 2030).first().Age == 30


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake"))
    for name in ("patient", "encounter", "claim", "procedure", "condition", "immunization", "diagnostic_report", "explanation_of_benefit"):
        tables.write_table(star.flat(spark, sf_dir, name), path, name)
    return path


def test_cost_job(spark, lake, tmp_path):
    tables.write_results(jobs.cost_results(spark, lake, str(tmp_path), AS_OF), str(tmp_path))
    by_type = tables.read_table(spark, str(tmp_path), "cost_by_encounter_type")
    full = tables.read_table(spark, lake, "claim").join(
        tables.read_table(spark, lake, "encounter"), "patient_reference", "left"
    )
    wanted = full.groupBy("type_text").agg(F.count("total_amount").alias("num_encounters"))
    assert rows(by_type.select("type_text", "num_encounters")) == rows(wanted)
    assert tables.read_table(spark, str(tmp_path), "costliest_claims").count() == 10


def test_disparity_job(spark, lake, tmp_path):
    results = jobs.disparity_results(spark, lake, str(tmp_path), AS_OF)
    assert results["value_by_category_table"].count() > 0
    long = results["usual_durations"].filter("keys = 'marital_status,gender'")
    usual = results["class_by_gender"]
    assert long.count() > 0 and usual.columns == ["gender", "Inpatient", "Ambulatory", "Emergency", "Unknown"]
    tables.write_results({"usual_durations": results["usual_durations"]}, str(tmp_path))


def test_risk_and_readmission_jobs(spark, lake, tmp_path):
    small = dict(trees=5, rounds=3, folds=2, grid={"maxDepth": (0, 4), "numTrees": (3,)})
    risk = jobs.risk_results(spark, lake, str(tmp_path / "risk"), AS_OF, **small)
    assert risk["forest_scores"].count() == risk["boosting_scores"].count() == 5
    again = jobs.readmission_results(spark, lake, str(tmp_path / "again"), AS_OF, **small)
    for results in (risk, again):
        points = {r.parameters: r.best for r in results["search_points"].collect()}
        assert points == {"maxDepth=0, numTrees=3": False, "maxDepth=4, numTrees=3": True}
        assert results["forest_cross_validation"].first().mse < 0.2
    assert risk["searched_scores"].count() == 5 and again["boosting_cross_validation"].count() == 1
    assert again["forest_metrics"].first().r2 > 0.5


def test_unknown_job():
    with pytest.raises(SystemExit):
        jobs.main("nothing", "a", "b")
