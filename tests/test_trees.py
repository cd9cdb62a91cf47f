"""Trees as tables of nodes, boosting with one job a round, and the parameter search that shares fits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from carelake.plans import boosting, models, trees


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(3)
    x = r.integers(0, 25, (600, 3)).astype(float)
    y = (x[:, 0] > 12) * 2.0 + x[:, 1] * 0.1 + r.normal(0, 0.3, 600)
    rows = [(f"p{i}", *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "patient_id string, a double, b double, c double, label double").repartition(3)


def plain_boosting(x, y, rounds, step, depth, ridge=1.0):
    """Level by level, one node after the other, on the values themselves."""
    start = y.mean()
    rest, score = y - start, np.full(len(y), start)

    def grow(rows, level):
        best = (1e-6, None)
        total, n = rest[rows].sum(), len(rows)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= cut]
                a, m = rest[left].sum(), len(left)
                gain = a**2 / (m + ridge) + (total - a) ** 2 / (n - m + ridge) - total**2 / (n + ridge)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (f, cut))
        if level == depth or best[1] is None:
            out[rows] = step * total / (n + ridge)
            return
        f, cut = best[1]
        grow(rows[x[rows, f] <= cut], level + 1)
        grow(rows[x[rows, f] > cut], level + 1)

    for _ in range(rounds):
        out = np.zeros(len(y))
        grow(np.arange(len(y)), 0)
        rest, score = rest - out, score + out
    return score


@pytest.mark.parametrize("partition_rows", [1000, 150])
def test_boosting_equals_growing_level_by_level(points, partition_rows):
    nodes, start = boosting.fitted(points, ["a", "b", "c"], rounds=20, step=0.3, depth=3, bins=64, partition_rows=partition_rows)
    scored = trees.boosted_scores(points, nodes, F.array("a", "b", "c"), 3, start).collect()
    x = np.array([(r.a, r.b, r.c) for r in scored])
    want = plain_boosting(x, np.array([r.label for r in scored]), 20, 0.3, 3)
    assert np.allclose(want, [r.prediction for r in scored], atol=1e-9)
    assert nodes.agg(F.countDistinct("tree")).first()[0] == 20


def test_histograms_count_each_row_once(monkeypatch):
    """A pass over the rows for each column, not one for each level; the nodes' sums are those of a plain walk."""
    r = np.random.default_rng(5)
    bins, rest = r.integers(0, 8, (3, 500)).astype(np.uint8), r.normal(0, 1, 500)
    feature, cut = np.full(15, -1), np.zeros(15, np.int64)
    feature[[0, 1, 2, 4]], cut[[0, 1, 2, 4]] = [0, 1, 2, 0], [3, 4, 1, 1]
    want = np.zeros((2, 7, 3, 8))
    for i in range(500):
        node = 0
        while node < 7:
            for c in range(3):
                want[:, node, c, bins[c, i]] += 1, rest[i]
            if feature[node] < 0:
                break
            node = 2 * node + 1 + int(bins[feature[node], i] > cut[node])
    passes, count = [], np.bincount
    monkeypatch.setattr(boosting.np, "bincount", lambda *a: passes.append(1) or count(*a))
    got = boosting._inner(boosting._histograms((bins, rest), feature, cut, 3, 8))
    assert np.allclose(got, want) and len(passes) == 2 * 3


def test_rounds_with_the_same_splits_need_no_job(spark, monkeypatch):
    """Labels that one split explains: the histograms of the later rounds follow from those of the first."""
    df = spark.range(900).selectExpr("id % 30 as a", "id % 7 as b", "double(id % 30 > 12) as label").repartition(3)
    jobs, summed = [], boosting._summed
    monkeypatch.setattr(boosting, "_summed", lambda *a: jobs.append(1) or summed(*a))
    nodes, start = boosting.fitted(df, ["a", "b"], rounds=40, step=0.1, depth=3, partition_rows=400)
    alone, _ = boosting.fitted(df, ["a", "b"], rounds=40, step=0.1, depth=3, partition_rows=1000)
    assert nodes.agg(F.countDistinct("tree")).first()[0] == 40 and len(jobs) < 10
    scored = [trees.boosted_scores(df, n, F.array(F.col("a").cast("double"), F.col("b").cast("double")), 3, start).orderBy("a", "b") for n in (nodes, alone)]
    x = np.array([(r.a, r.b) for r in scored[0].collect()], float)
    want = plain_boosting(x, np.array([r.label for r in scored[0].collect()]), 40, 0.1, 3)
    assert all(np.allclose(want, [r.prediction for r in s.collect()], atol=1e-9) for s in scored)


def test_boosting_takes_odd_rows(spark, points):
    odd = spark.createDataFrame([("n", None, 1.0, float("nan"), 1.0), ("m", 1.0, None, None, None)], points.schema)
    nodes, start = boosting.fitted(points.union(odd), ["a", "b", "c"], rounds=3, depth=2)
    scored = trees.boosted_scores(odd, nodes, F.array("a", "b", "c"), 2, start).collect()
    assert all(r.prediction is not None for r in scored)
    # a missing value goes the way of the lowest one
    low = trees.boosted_scores(odd.na.fill(-1e9).replace(float("nan"), -1e9), nodes, F.array("a", "b", "c"), 2, start)
    assert [r.prediction for r in scored] == [r.prediction for r in low.collect()]
    nodes, start = boosting.fitted(points.limit(0), ["a", "b"], rounds=3)
    assert nodes.count() == 0 and start == 0.0
    nodes, start = boosting.fitted(points.withColumn("label", F.lit(2.5)), ["a"], rounds=2, depth=2)
    assert nodes.count() == 2 and start == 2.5


def test_scores_from_nodes_equal_the_forest(points, tmp_path):
    # b as categories: splits by left values
    coded = points.withColumn("b", (F.col("b") % 4))
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(coded)
    meta = {"ml_attr": {"attrs": {"numeric": [{"idx": 0}, {"idx": 2}], "nominal": [{"idx": 1, "vals": ["0", "1", "2", "3"]}]}, "num_attrs": 3}}
    rows = rows.withMetadata("features", meta)
    forest = RandomForestRegressor(numTrees=7, maxDepth=6, seed=1).fit(rows)
    nodes = trees.nodes_of(forest, str(tmp_path / "forest"))
    assert nodes.filter("left_values is not null").count() and nodes.filter("threshold is not null").count()
    got = {r.patient_id: r.prediction for r in trees.forest_scores(rows, nodes, vector_to_array("features"), 6).collect()}
    want = {r.patient_id: r.prediction for r in forest.transform(rows).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    # the first trees alone
    values = trees.tree_values(rows, nodes, vector_to_array("features"), [2, 6]).collect()
    tree = forest.trees[3]
    for r in values[:50]:
        assert len(r["values"]) == 7 and abs(r["values"][3][1] - tree.predict(r.features)) < 1e-9


def test_packed_is_linear_in_the_nodes(spark):
    """A tree of many nodes, one of them missing; a look-up of each number among all would take hours."""
    last = 60_000
    columns = ["0 as tree", "int(id) as node", "int(null) as feature", "double(null) as threshold", "array(0.5D) as left_values", "int(null) as left", "int(null) as right", "double(id) as value"]
    nodes = spark.range(last + 1).filter("id <> 17").selectExpr(*columns).repartition(3)
    got = trees.packed(nodes).selectExpr("trees[0] as t").selectExpr("size(t) as n", "t[17].value as gap", "forall(t, x -> x.value is null or x.node = x.value) as placed").first()
    assert tuple(got) == (last + 1, None, True)


@pytest.fixture(scope="module")
def people(spark):
    rows = [(f"p{i}", ["ON", "QC", None][i % 3], i % 2, float(i % 41), i % 80, i % 5, float(i % 80 > 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "patient_id string, state string, has_chronic_conditions int, total_healthcare_cost double, age int, num_claims int, label double")
    rest = [c for c in models.NUMERIC if c not in df.columns]
    return df.withColumns({c: (F.col("age") * (k + 3) % 17).cast("double") for k, c in enumerate(rest)}).withColumn("is_senior", (F.col("age") > 65).cast("int"))


def test_search_equals_cross_validation(people, tmp_path, monkeypatch):
    """Without resampling, trees depend on the rows alone, so each point has the same error."""
    regressor = models.readmission_forest(numTrees=3, bootstrap=False, featureSubsetStrategy="all")
    values = {"numTrees": (1, 3), "maxDepth": (1, 2, 4), "minInstancesPerNode": (2, 30)}
    found = models.searched(regressor, people, str(tmp_path), values, folds=3)
    grid = models.grid_points(regressor, values)
    plain = models.cross_validated(models.pipeline(regressor), people, grid, folds=3)
    want = {tuple(sorted((p.name, v) for p, v in point.items())): e for point, e in zip(grid, plain.avgMetrics)}
    got = {tuple(sorted((n, r[n]) for n in values)): r.mse for r in found.points().collect()}
    assert len(got) == 12 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert found.best == models.best_parameters(plain, values)
    assert found.model.stages[-1].getOrDefault("maxDepth") == found.best["maxDepth"]
    # finished fits are not done again
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda *_: pytest.fail("fitted again"))
    with pytest.raises(BaseException, match="fitted again"):  # the refit of the best point
        models.searched(regressor, people, str(tmp_path), values, folds=3)


def test_scoring_is_dealt_to_all_cores(people, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "SCORED_ROWS", 50)
    values, seen, scored = {"numTrees": (1,), "maxDepth": (2,)}, [], trees.tree_values
    monkeypatch.setattr(trees, "tree_values", lambda rows, *a: seen.append((rows.rdd.getNumPartitions(), rows.count())) or scored(rows, *a))
    models.searched(models.readmission_forest(), people.coalesce(1), str(tmp_path), values, folds=2)
    assert [n for n, _ in seen] == [4, 4] and sum(n for _, n in seen) == 400


def test_search_has_the_documented_points(people, monkeypatch, tmp_path):
    seen = []

    def run(session, f, jobs, parallelism):
        seen.append(jobs)
        if len(seen) == 2:
            raise KeyboardInterrupt

    monkeypatch.setattr(models, "_in_threads", run)
    with pytest.raises(KeyboardInterrupt):
        models.searched(models.readmission_forest(), people, str(tmp_path))
    folds, fits = seen
    sizes = len(models.GRID["numTrees"]) * len(models.GRID["maxDepth"])
    assert len(folds) == 5 and len(fits) * sizes == 54 * 5


def test_points_that_grow_the_same_forest_share_a_fit(people, tmp_path, monkeypatch):
    """"sqrt" and "log2" draw 5 features a node of 17: one fit a fold, the errors of a fit for each strategy."""
    fits, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, *rest: fits.append(self.getFeatureSubsetStrategy()) or fit(self, *rest))
    values = {"numTrees": (2, 3), "maxDepth": (2, 4), "featureSubsetStrategy": ("log2", "sqrt", "all")}
    found = models.searched(models.readmission_forest(), people, str(tmp_path / "all"), values, folds=2)
    assert sorted(fits[:-1]) == ["all", "all", "log2", "log2"]  # and the refit of the best point
    got = {tuple(r): r.mse for r in found.errors.drop("place").collect()}
    assert len(got) == 2 * 2 * 2 * 3
    for strategy in values["featureSubsetStrategy"]:
        alone = models.searched(models.readmission_forest(), people, str(tmp_path / strategy), {**values, "featureSubsetStrategy": (strategy,)}, folds=2)
        assert all(got[tuple(r)] == r.mse for r in alone.errors.drop("place").collect())
    # the grid's order decides between equal points, whatever the order in which errors are read
    even = {"numTrees": (1,), "maxDepth": (3,), "featureSubsetStrategy": ("sqrt", "log2")}
    assert models.searched(models.readmission_forest(), people, str(tmp_path / "even"), even, folds=5).best["featureSubsetStrategy"] == "sqrt"


def test_rows_walk_in_blocks(spark, monkeypatch):
    """Odd rows against a plain walk; the plan has no step of an interpreted expression."""
    columns = "tree int, node int, feature int, threshold double, left_values array<double>, left int, right int, value double"
    nodes = spark.createDataFrame(
        [
            (0, 0, 0, 1.5, None, 1, 4, 0.0), (0, 1, 1, None, [0.0, 2.0], 2, 3, 1.0), (0, 2, None, None, None, None, None, 2.0), (0, 3, None, None, None, None, None, 3.0),
            (0, 4, 2, -1.0, None, 5, 6, 4.0), (0, 5, None, None, None, None, None, 5.0), (0, 6, None, None, None, None, None, 6.0), (3, 0, None, None, None, None, None, 7.0),
        ],
        columns,
    )
    nan = float("nan")
    x = [[1.0, 0.0, 0.0], [1.0, 1.0, 0.0], [1.0, 2.0, 0.0], [1.0, nan, 0.0], [nan, 3.0, 0.0], [None, None, None], [2.0, 0.0, -1.0], [2.0, 0.0, 0.5], [2.0], [], None]
    want = [2, 3, 2, 2, 3, 2, 5, 6, 5, 2, 2]
    rows = spark.createDataFrame(list(enumerate(x)), "id int, x array<double>")
    monkeypatch.setattr(trees, "BLOCK", 6)
    scored = trees.tree_values(rows, nodes, F.col("x"), [0, 1, 2])
    assert "lambda" not in scored._jdf.queryExecution().toString()
    got = {r.id: r["values"] for r in scored.collect()}
    first = [1.0 if v is None or not v or v[0] is None or not v[0] > 1.5 else 4.0 for v in x]
    assert got == {i: [[0.0, first[i], float(w)], [7.0, 7.0, 7.0]] for i, w in enumerate(want)}
    assert [r["values"] for r in trees.tree_values(rows, nodes.limit(0), F.col("x"), [2]).collect()] == [[]] * len(x)
