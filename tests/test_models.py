"""Models by what they learn of a planted signal, and the pieces around them exactly."""

import threading

import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from carelake.plans import features, models
from carelake.sources import tables
from carelake.testbed import book, queries_models


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    """400 patients; the label follows from num_claims."""
    df = spark.range(400).select(
        F.concat(F.lit("p"), "id").alias("patient_id"),
        F.element_at(F.array(*map(F.lit, ("AB", "ON", "QC"))), (F.col("id") % 3 + 1).cast("int")).alias("state"),
        (F.col("id") % 2).cast("int").alias("has_chronic_conditions"),
        (F.col("id") % 5 == 0).cast("int").alias("is_senior"),
        ((F.col("id") * 7 % 40) > 19).cast("int").alias("label"),
        *(((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(models.NUMERIC) if c != "num_claims"),
        (F.col("id") * 7 % 40).cast("double").alias("num_claims"),
    )
    return tables.kept(df, str(tmp_path_factory.mktemp("people")), "features")


def test_hold_out(people):
    train, test = models.hold_out_share(people)
    assert train.count() + test.count() == 400 and 50 < test.count() < 110
    assert train.join(test, "patient_id", "left_semi").count() == 0
    # The same rows however the table is partitioned.
    again = models.hold_out_share(people.repartition(7, "state"))[1]
    assert rows(again.select("patient_id")) == rows(test.select("patient_id"))
    train, test = models.hold_out_rows(people)
    assert (train.count(), test.count()) == (395, 5)


@pytest.mark.parametrize(
    "make, settings",
    [
        (models.risk_forest, {"numTrees": 10}),
        (models.readmission_forest, {"numTrees": 20}),
        (models.readmission_boosting, {"maxIter": 5, "maxDepth": 4}),
    ],
)
def test_pipelines_learn(people, make, settings):
    regressor = make(**settings)
    train, test = models.hold_out_share(people)
    fitted = models.pipeline(regressor).fit(train)
    scored = models.scores(fitted, test)
    measured = models.metrics(scored).first()
    assert measured.r2 > 0.5
    for name in ("mse", "r2"):
        assert abs(measured[name] - RegressionEvaluator(labelCol="label", metricName=name).evaluate(scored)) < 1e-9
    assert rows(scored) == rows(models.scores(models.pipeline(regressor).fit(train), test))


def test_boosting_on_plain_columns(people):
    train, test = models.hold_out_share(people)
    codes = models.state_codes(train.filter("state <> 'AB'"), test)
    assert codes.labels == ["AB", "ON", "QC"]
    fitted = models.boosting_pipeline(codes, models.risk_boosting(maxIter=10, stepSize=0.3)).fit(train)
    assert models.metrics(models.scores(fitted, test)).first().r2 > 0.5


def test_scores_of_a_known_threshold(people):
    """With every value a bin and all features in each split, a score above a half is the label."""
    train, test = models.hold_out_share(people)
    forest = models.risk_forest(numTrees=100, maxBins=64)
    scored = models.scores(models.pipeline(forest).fit(train), test)
    assert scored.count() > 0 and scored.filter("(prediction > 0.5) <> (label = 1)").count() == 0


def test_defaults(spark):
    assert models.risk_boosting().getMaxIter() == 1000 and models.risk_boosting().getStepSize() == 0.01
    assert models.risk_forest().getNumTrees() == models.readmission_forest().getNumTrees() == 100
    assert len(models.grid_points(models.readmission_forest())) == 54


def test_missing_and_unseen(spark):
    train = spark.createDataFrame([("a", "ON", 1.0), ("b", "ON", 3.0), ("c", "QC", None), ("d", None, 100.0)], "patient_id string, state string, n double")
    new = spark.createDataFrame([("e", "BC", None), ("f", None, 2.0), ("g", "QC", 2.0)], "patient_id string, state string, n double")
    coded = Pipeline(stages=models.categorical_stages(["state"])).fit(train).transform(new)
    got = rows(coded.select("patient_id", vector_to_array("state_coded")))
    assert got == [("e", [0.0, 0.0]), ("f", [1.0, 0.0]), ("g", [0.0, 1.0])]
    numbers = Pipeline(stages=models.numeric_stages(["n"])).fit(train).transform(new)
    assert {r.patient_id: r.n_filled for r in numbers.collect()}["e"] == 3.0  # the median


def test_cross_validation_and_search(people):
    regressor = models.readmission_forest(numTrees=3)
    # One tree of depth 0 without resampling predicts the mean of the folds it learned from.
    stump = models.readmission_forest(numTrees=1, maxDepth=0, bootstrap=False)
    error = models.cross_validated(models.pipeline(stump), people, folds=3).avgMetrics[0]
    folded = [(r.fold, r.label) for r in models.with_fold(people, 3).select("fold", "label").collect()]
    wanted = []
    for k in range(3):
        inside = [y for f, y in folded if f == k]
        learned = [y for f, y in folded if f != k]
        mean = sum(learned) / len(learned)
        wanted.append(sum((y - mean) ** 2 for y in inside) / len(inside))
    assert abs(error - sum(wanted) / 3) < 1e-9
    found = models.cross_validated(models.pipeline(regressor), people, folds=3)
    assert len(found.avgMetrics) == 1 and found.avgMetrics[0] < 0.2
    values = {"maxDepth": (1, 6), "minInstancesPerNode": (2,)}
    grid = models.grid_points(regressor, values)
    found = models.cross_validated(models.pipeline(regressor), people, grid, folds=2)
    assert models.best_parameters(found, values) == {"maxDepth": 6, "minInstancesPerNode": 2}


def test_folds_are_fitted_side_by_side_with_the_same_results(people, monkeypatch):
    estimator = models.pipeline(models.readmission_forest(numTrees=3))
    settings = dict(estimator=estimator, evaluator=RegressionEvaluator(labelCol="label", metricName="mse"), numFolds=3, foldCol="fold")
    grid = models.grid_points(estimator.getStages()[-1], {"maxDepth": (1, 6)})
    for points in (grid[:1], grid):
        plain = CrossValidator(estimatorParamMaps=points, **settings).fit(models.with_fold(people, 3))
        found = models.cross_validated(estimator, people, points, folds=3)
        assert found.avgMetrics == pytest.approx(plain.avgMetrics) and found.stdMetrics == pytest.approx(plain.stdMetrics)
        assert rows(models.scores(found, people)) == rows(models.scores(plain, people))
    # two fits meet: neither goes on before the other has begun
    both, fit = threading.Barrier(2, timeout=60), Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, *rest: (both.wait(), fit(self, *rest))[1])
    assert len(models.cross_validated(estimator, people, folds=3).avgMetrics) == 1  # 3 folds and the refit
    monkeypatch.undo()
    with pytest.raises(ValueError, match="is empty"):
        models.cross_validated(estimator, people.limit(1), folds=3)


def test_feature_defaults(spark):
    """A patient without any rows has zeros, and no first encounter."""
    make = spark.createDataFrame
    tables = {
        "patient": make([("p1", "CA", "1950-01-01"), ("p2", "ON", None)], "patient_id string, state string, birth_date string"),
        "encounter": make([("urn:uuid:p1", "e1", "finished", "2020-02-01", "2020-02-02"), ("urn:uuid:p1", "e2", "planned", "2019-01-01", "2019-01-02")], "patient_reference string, encounter_id string, status string, start_time string, end_time string"),
        "claim": make([("urn:uuid:p1", "c1", 2.5), ("urn:uuid:p1", "c2", None)], "patient_reference string, claim_id string, total_amount double"),
        "condition": make([("urn:uuid:p1", "d1", "CHRONIC pain"), ("urn:uuid:p1", None, "cold")], "patient_reference string, condition_id string, condition_code_display string"),
        "procedure": make([("urn:uuid:p1", "r1")], "subject_reference string, procedure_id string"),
        "immunization": make([("urn:uuid:p9", "u1")], "patient_reference string, immunization_id string"),
        "diagnostic_report": make([("urn:uuid:p1", "g1")], "subject_reference string, diagnostic_report_id string"),
    }
    got = {r.patient_id: r.asDict() for r in features.feature_table(tables, "2024-12-01", span=True).collect()}
    assert got["p1"] == dict(
        patient_id="p1", state="CA", has_chronic_conditions=1, total_healthcare_cost=2.5, age=74, is_senior=1, region_risk=0.8, label=1,
        num_encounters=2, completed_encounters=1, num_claims=2, total_claim_amount=2.5, num_conditions=1, num_procedures=1,
        num_immunizations=0, num_diagnostic_reports=1, first_encounter="2019-01-01", last_encounter="2020-02-02",
    )
    empty = got["p2"]
    assert empty["first_encounter"] is None and empty["last_encounter"] is None
    assert all(empty[c] == 0 for c in ("num_encounters", "num_claims", "total_claim_amount", "has_chronic_conditions", "age"))


def test_no_row_is_lost_to_a_missing_key(spark):
    people = spark.createDataFrame([(str(i) if i > 1 else None,) for i in range(300)], "patient_id string")
    for share in (0.0, 0.2, 1.0):
        train, test = models.hold_out_share(people, share)
        assert train.count() + test.count() == 300
        assert share not in (0.0, 1.0) or test.count() == 300 * share
    train, test = models.hold_out_rows(people)
    assert train.count() + test.count() == 300 and 5 <= test.count() <= 6
    assert models.with_fold(people).filter("fold is null").count() == 0
    assert [t.count() for t in models.hold_out_rows(people.limit(0))] == [0, 0]
    with pytest.raises(ValueError):
        models.hold_out_share(people, 1.5)


@pytest.mark.parametrize(
    "name, rounds, trees, points",
    [
        ("m21_readmission_boosting_scores", (100, 0.3, 10), None, None),
        ("m24_cross_validated_mse", None, (100, 10), 1),
    ],
)
def test_queries_fit_the_documented_numbers(spark, sf_dir, monkeypatch, name, rounds, trees, points):
    """The estimators that the queries would fit, seen where fitting begins."""

    class Seen(Exception):
        pass

    def fit(self, rows, params=None):
        raise Seen(self)

    monkeypatch.setattr(Pipeline, "fit", fit)
    monkeypatch.setattr(CrossValidator, "fit", fit)
    monkeypatch.setattr(queries_models, "_features", lambda lake: None)
    monkeypatch.setattr(queries_models, "_settled", lambda rows: None)
    for split in ("hold_out_rows", "hold_out_share"):
        monkeypatch.setattr(models, split, lambda rows: (None, None))
    monkeypatch.setattr(models, "with_fold", lambda rows, folds: rows)
    monkeypatch.setattr(models, "state_codes", lambda *_: StringIndexerModel.from_labels(["ON"], "state", "state_code"))
    with pytest.raises(Seen) as seen:
        book.QUERIES[name](spark, sf_dir)
    estimator = seen.value.args[0]
    if points:
        assert len(estimator.getEstimatorParamMaps()) == points and estimator.getNumFolds() == 5
        estimator = estimator.getEstimator()
    regressor = estimator.getStages()[-1]
    if rounds:
        assert (regressor.getMaxIter(), regressor.getStepSize(), regressor.getMaxDepth()) == rounds
    else:
        assert (regressor.getNumTrees(), regressor.getMaxDepth()) == trees


def test_risk_boosting_has_the_documented_numbers(spark, sf_dir, monkeypatch):
    seen = {}

    def fitted(rows, columns, label, **settings):
        seen.update(settings)
        raise KeyboardInterrupt

    monkeypatch.setattr(models.boosting, "fitted", fitted)
    with pytest.raises(KeyboardInterrupt):
        book.QUERIES["m20_boosting_scores"](spark, sf_dir)
    assert seen == dict(rounds=1000, step=0.01, depth=6)
