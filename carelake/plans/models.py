"""Tree regressors on the feature table, as `pyspark.ml` pipelines.

Training stays on the executors. The driver sees fitted parameters and metrics only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from hashlib import sha256
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from carelake.plans import boosting, trees
from carelake.plans.features import KEY
from carelake.sources import tables

LABEL = "label"
# The features of the models.
NUMERIC = (
    "total_healthcare_cost",
    "age",
    "region_risk",
    "num_encounters",
    "completed_encounters",
    "num_claims",
    "total_claim_amount",
    "num_conditions",
    "num_procedures",
    "num_immunizations",
    "num_diagnostic_reports",
)
CATEGORICAL = ("state", "has_chronic_conditions", "is_senior")
SEED = 42
FOLDS = 5

# The points of the parameter search.
GRID = {
    "numTrees": (100, 200, 300),
    "maxDepth": (10, 15, 20),
    "minInstancesPerNode": (2, 4, 6),
    "featureSubsetStrategy": ("sqrt", "log2"),
}


#: Rows a task scores in a search, until all cores have a task.
SCORED_ROWS = 250

#: Levels of the risk forest, at most: trees live in the driver, and on noisy labels deeper ones would
#: grow with the rows.
RISK_DEPTH = 12


# --- hold-out and folds ---------------------------------------------------------------------------


def draw(seed: int = SEED, key: str = KEY) -> Column:
    """A hexadecimal number per row that depends on its key and the seed alone, so a split is the same
    whenever and wherever a partition is computed. A NULL key draws like an empty one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def _number(seed: int) -> Column:
    """The first 32 bits of the draw."""
    return F.conv(F.substring(draw(seed), 1, 8), 16, 10).cast("long")


def hold_out_share(features: DataFrame, share: float = 0.2, seed: int = SEED):
    """Train and test rows, about `share` (0 to 1) of them for the test. Every row is in one of them."""
    if not 0 <= share <= 1:
        raise ValueError(f"share {share} is not within 0 and 1")
    held = _number(seed) < int(share * 2**32)
    return features.filter(~held), features.filter(held)


def hold_out_rows(features: DataFrame, rows: int = 5, seed: int = SEED):
    """Train and test rows, `rows` for the test: those with the lowest draw. Rows that share the key of
    the last of them go with it; an empty table gives two empty ones."""
    lowest = features.select(draw(seed).alias("d")).orderBy("d").limit(rows)
    last = lowest.agg(F.max("d")).first()[0] or ""
    return features.filter(draw(seed) > last), features.filter(draw(seed) <= last)


def with_fold(features: DataFrame, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    return features.withColumn("fold", (_number(seed + 1) % folds).cast("int"))


# --- preparation ----------------------------------------------------------------------------------


def numeric_stages(columns: Sequence[str] = NUMERIC, into: str = "numeric") -> list:
    """Median for missing numbers, then mean 0 and deviation 1."""
    filled = [f"{c}_filled" for c in columns]
    return [
        Imputer(strategy="median", inputCols=list(columns), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol=f"{into}_raw"),
        StandardScaler(inputCol=f"{into}_raw", outputCol=into, withMean=True, withStd=True),
    ]


def categorical_stages(columns: Sequence[str] = CATEGORICAL) -> list:
    """The most frequent value for missing ones, then a 0/1 column per value. A value not seen in
    training has 0 in all of them. All is learned when the stages are fitted, so once per fold."""
    text = ", ".join(f"cast({c} as string) as {c}_text" for c in columns)
    # Values are numbered by frequency, so a missing one takes the first number.
    filled = ", ".join(f"if({c}_text is null, 0.0D, {c}_index) as {c}_filled" for c in columns)
    return [
        SQLTransformer(statement=f"select *, {text} from __THIS__"),
        # "keep" gives unseen values a number beyond those of training, which the encoder leaves out.
        StringIndexer(
            inputCols=[f"{c}_text" for c in columns],
            outputCols=[f"{c}_index" for c in columns],
            handleInvalid="keep",
        ),
        SQLTransformer(statement=f"select *, {filled} from __THIS__"),
        OneHotEncoder(
            inputCols=[f"{c}_filled" for c in columns],
            outputCols=[f"{c}_coded" for c in columns],
            handleInvalid="keep",
            dropLast=True,
        ),
    ]


def preparation() -> list:
    coded = [f"{c}_coded" for c in CATEGORICAL]
    return [
        *numeric_stages(),
        *categorical_stages(),
        VectorAssembler(inputCols=["numeric", *coded], outputCol="features"),
    ]


def state_codes(train: DataFrame, test: DataFrame) -> StringIndexerModel:
    """States numbered in alphabetical order, over training and test rows together."""
    states = train.select("state").unionByName(test.select("state"))
    indexer = StringIndexer(
        inputCol="state", outputCol="state_code", stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return indexer.fit(states)


# --- models ---------------------------------------------------------------------------------------


def risk_forest(**settings) -> RandomForestRegressor:
    """Trees of up to RISK_DEPTH levels on all features; `maxDepth` up to 30 is a setting."""
    defaults = dict(numTrees=100, maxDepth=RISK_DEPTH, featureSubsetStrategy="all")
    return RandomForestRegressor(labelCol=LABEL, seed=SEED, **{**defaults, **settings})


def readmission_forest(**settings) -> RandomForestRegressor:
    defaults = dict(
        numTrees=100, maxDepth=10, minInstancesPerNode=4, featureSubsetStrategy="sqrt"
    )
    return RandomForestRegressor(labelCol=LABEL, seed=SEED, **{**defaults, **settings})


def risk_boosting(**settings) -> GBTRegressor:
    defaults = dict(maxIter=1000, stepSize=0.01, maxDepth=6)
    return GBTRegressor(labelCol=LABEL, seed=SEED, **{**defaults, **settings})


def readmission_boosting(**settings) -> GBTRegressor:
    defaults = dict(maxIter=100, stepSize=0.3, maxDepth=10)
    return GBTRegressor(labelCol=LABEL, seed=SEED, **{**defaults, **settings})


#: Rounds, rate and levels of the boosted risk trees.
RISK_ROUNDS = dict(rounds=1000, step=0.01, depth=6)
BOOSTED = (*NUMERIC, "has_chronic_conditions", "is_senior", "state_code")


def risk_boosted_scores(train: DataFrame, test: DataFrame, path: str, **settings) -> DataFrame:
    """Scores of the test rows by trees boosted on the training rows, which are kept in `path` as a table
    of nodes. One job a round at most (see `boosting`); the columns go in as they are, states as their number."""
    settings = {**RISK_ROUNDS, **settings}
    codes = state_codes(train, test)
    nodes, start = boosting.fitted(codes.transform(train), BOOSTED, LABEL, **settings)
    nodes = tables.kept(nodes, path, "boosted_nodes")
    columns = F.array(*(F.col(c).cast("double") for c in BOOSTED))
    return trees.boosted_scores(codes.transform(test), nodes, columns, settings["depth"], start).select(KEY, LABEL, "prediction")


def pipeline(regressor) -> Pipeline:
    return Pipeline(stages=[*preparation(), regressor])


def boosting_pipeline(codes: StringIndexerModel, regressor) -> Pipeline:
    """Boosting takes the columns as they are, with the state as its number."""
    columns = [*NUMERIC, "has_chronic_conditions", "is_senior", "state_code"]
    return Pipeline(stages=[codes, VectorAssembler(inputCols=columns, outputCol="features"), regressor])


def scores(model: PipelineModel | CrossValidatorModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select(KEY, LABEL, "prediction")


def metrics(scored: DataFrame) -> DataFrame:
    """Mean squared error and R2 of scored rows."""
    error = F.col(LABEL) - F.col("prediction")
    mse = F.avg(error * error)
    return scored.agg(
        mse.alias("mse"), (1 - F.try_divide(mse, F.var_pop(F.col(LABEL)))).alias("r2")
    )


class SideBySide(CrossValidator):
    """A `CrossValidator` with a column of folds and the same results, which takes up its fits whatever their folds,
    `parallelism` at a time: one uses the cores that another leaves idle at the end of a pass or while the driver grows
    its trees. All read one cached table. A fit keeps its own draws of the rows, so memory goes with `parallelism`."""

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        estimator, grid, evaluator = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator()
        folds, fold_of, session = self.getNumFolds(), F.col(self.getFoldCol()), dataset.sparkSession
        rows = dataset.cache()
        try:
            sizes = dict(rows.groupBy(fold_of).count().collect())
            for fold in range(folds):
                if sum(sizes.values()) == sizes.get(fold, 0):
                    raise ValueError(f"The training data at fold {fold} is empty.")
                if not sizes.get(fold):
                    raise ValueError(f"The validation data at fold {fold} is empty.")

            def run(job: tuple) -> PipelineModel | float:
                fold, point = job
                if fold is None:
                    return estimator.fit(rows, point)
                model = estimator.fit(rows.filter(fold_of != fold), point)
                return evaluator.evaluate(model.transform(rows.filter(fold_of == fold), point))

            # with one point the best is known, and its refit need not wait for the errors
            refit = [(None, grid[0])] if len(grid) == 1 else []
            found = _in_threads(session, run, refit + list(product(range(folds), grid)), self.getParallelism())
            errors = np.array(found[len(refit) :]).reshape(folds, len(grid))
            means = errors.mean(axis=0)
            place = int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))
            best = found[0] if refit else run((None, grid[place]))
            return self._copyValues(CrossValidatorModel(best, means.tolist(), [], errors.std(axis=0).tolist()))
        finally:
            rows.unpersist()


def cross_validated(estimator, rows: DataFrame, grid=None, folds: int = FOLDS, parallelism: int = 2) -> CrossValidatorModel:
    """Fit on every fold and grid point, and refit the best on all rows. `avgMetrics` of the result
    are the mean squared errors."""
    validator = SideBySide(
        estimator=estimator,
        estimatorParamMaps=grid or ParamGridBuilder().build(),
        evaluator=RegressionEvaluator(labelCol=LABEL, metricName="mse"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    return validator.fit(with_fold(rows, folds))


def grid_points(regressor: RandomForestRegressor, values=GRID) -> list:
    builder = ParamGridBuilder()
    for name, points in values.items():
        builder = builder.addGrid(regressor.getParam(name), list(points))
    return builder.build()


def best_parameters(found: CrossValidatorModel, values=GRID) -> dict[str, object]:
    best = found.bestModel.stages[-1]
    return {name: best.getOrDefault(best.getParam(name)) for name in values}


@dataclass
class Search:
    """What a parameter search found: the mean squared errors by fold and point, the best point, its model."""

    errors: DataFrame
    best: dict[str, object]
    model: PipelineModel

    def points(self) -> DataFrame:
        """The mean error over the folds of each point."""
        point = [c for c in self.errors.columns if c not in ("fold", "mse", "place")]
        return self.errors.groupBy("place", *point).agg(F.avg("mse").alias("mse"))


def _features_a_node(strategy: str, features: int) -> int | str:
    """How many features a node draws, which is all that a forest takes from its `featureSubsetStrategy`."""
    counts = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log(features) / math.log(2)))}
    return counts.get(strategy, strategy)


def searched(regressor: RandomForestRegressor, rows: DataFrame, path: str, values=GRID, folds: int = FOLDS, parallelism: int | None = None) -> Search:
    """The parameter search of a forest: every point of the grid on every fold, then the best one on all rows.

    Each fold is prepared once (medians, codes, scaling of its training rows) and kept as a table. Points
    that differ in trees and levels only share a fit: the largest forest has the smaller ones in it, its
    first trees down to a level, for trees are drawn apart and a node's split does not depend on what grows
    below. All of these points are scored in one walk down the trees, by all cores: a row takes thousands of steps,
    and a table of features is few files. So the documented 54 points on 5 folds
    are 30 fits in place of 270. Points whose strategies draw as many features a node grow the same forest on the
    same draws, so one fit serves them: with 17 to 25 features, "sqrt" and "log2" both draw 5.

    `parallelism` fits run at a time, unless given as many as occupy the cores, and 4 at least: a fit of few partitions
    has few tasks. Each fit keeps its rows' draws and last nodes (some 4 bytes a row and tree, a few times over; beyond
    memory, on disk), so that a pass does not walk down from the roots again.

    Finished fits are noted in `path`, below a digest of the rows and settings, so the same search started
    again goes on where it ended.
    """
    sizes = {name: sorted(values.get(name, (regressor.getOrDefault(name),))) for name in ("numTrees", "maxDepth")}
    others = {name: points for name, points in values.items() if name not in sizes}
    session, folded = rows.sparkSession, with_fold(rows, folds)
    marked = rows.select("*", F.spark_partition_id().alias("_task"))
    *own, tasks = marked.agg(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")), F.size(F.collect_set("_task"))).first()
    parallelism = parallelism or max(math.ceil(session.sparkContext.defaultParallelism / max(tasks, 1)), 4)
    parts = min(math.ceil(own[0] / folds / SCORED_ROWS), session.sparkContext.defaultParallelism)
    settings = sorted((p.name, str(v)) for p, v in regressor.extractParamMap().items())
    path = f"{path}/{sha256(repr((tuple(own), settings, sorted(values.items()), folds)).encode()).hexdigest()[:16]}"

    def prepared(fold: int) -> DataFrame:
        name = f"fold-{fold}"
        if done := _read(session, f"{path}/{name}"):
            return done
        fitted = Pipeline(stages=preparation()).fit(folded.filter(F.col("fold") != fold))
        kept = fitted.transform(folded).select(LABEL, "features", (F.col("fold") == fold).alias("held"))
        return tables.kept(kept, path, name)

    def alike(fold: int, point: dict) -> dict:
        """The first point that grows the same forest."""
        width = prepared_folds[fold].schema["features"].metadata["ml_attr"]["num_attrs"]
        draws = [{k: _features_a_node(v, width) if k == "featureSubsetStrategy" else v for k, v in p.items()} for p in points]
        return points[draws.index(draws[points.index(point)])]

    def fit(job: tuple[int, dict]) -> DataFrame | None:
        fold, point = job
        if alike(fold, point) != point:
            return None
        name = "-".join(map(str, (fold, *point.values())))
        if done := _read(session, f"{path}/errors-{name}"):
            return done
        largest = dict(numTrees=sizes["numTrees"][-1], maxDepth=sizes["maxDepth"][-1], cacheNodeIds=True)
        table = prepared_folds[fold]
        forest = regressor.copy({regressor.getParam(k): v for k, v in {**point, **largest}.items()}).fit(table.filter("not held"))
        nodes = trees.nodes_of(forest, f"{path}/forest-{name}")
        held = table.filter("held").repartition(parts) if parts > 1 else table.filter("held")
        scored = trees.tree_values(held, nodes, vector_to_array("features"), sizes["maxDepth"])
        errors = []
        for n, (level, depth) in product(sizes["numTrees"], enumerate(sizes["maxDepth"])):
            each = F.transform(F.slice("values", 1, n), _at(level))
            error = F.col(LABEL) - F.aggregate(each, F.lit(0.0), lambda total, v: total + v) / n
            errors.append(F.struct(F.lit(n).alias("numTrees"), F.lit(depth).alias("maxDepth"), F.avg(error * error).alias("mse")))
        found = scored.agg(F.array(*errors).alias("e")).select(F.lit(fold).alias("fold"), F.explode("e").alias("e"))
        named = [F.lit(v).alias(k) for k, v in point.items()]
        return tables.kept(found.select("fold", "e.numTrees", "e.maxDepth", *named, "e.mse"), path, f"errors-{name}")

    points = [dict(zip(others, p)) for p in product(*others.values())]
    prepared_folds = _in_threads(session, prepared, list(range(folds)), parallelism)
    jobs = list(product(range(folds), points))
    found = _in_threads(session, fit, jobs, parallelism)
    errors = None
    for (fold, point), own in zip(jobs, found):
        if own is None:
            own = found[jobs.index((fold, alike(fold, point)))].withColumns({k: F.lit(v) for k, v in point.items()})
        errors = own if errors is None else errors.unionByName(own)
    # points in the order of the grid, which decides between equal errors
    names = [n for n in values if n in errors.columns]
    order = F.lit(0)
    for n in names:
        order = order * len(values[n]) + F.array_position(F.array(*map(F.lit, values[n])), F.col(n)) - 1
    errors = tables.kept(errors.withColumn("place", order), path, "errors")
    # added up fold by fold, for sums in any order would part equal points by their last bits
    by_fold = F.transform(F.array_sort(F.collect_list(F.struct("fold", "mse"))), lambda e: e["mse"])
    by_fold = F.filter(by_fold, lambda e: e.isNotNull())
    mean = F.try_divide(F.aggregate(by_fold, F.lit(0.0), lambda total, e: total + e), F.size(by_fold))
    best = errors.groupBy("place", *names).agg(mean.alias("mse")).orderBy("mse", "place").first()
    best = {n: best[n] for n in names}
    model = pipeline(regressor.copy({regressor.getParam(k): v for k, v in {**best, "cacheNodeIds": True}.items()})).fit(rows)
    return Search(errors, best, model)


def _in_threads(session, run, jobs: list, parallelism: int) -> list:
    """Results of the jobs in their order. Each has its own copy of the session's local properties."""
    with ThreadPool(parallelism) as pool:
        own = [inheritable_thread_target(session)(partial(run, job)) for job in jobs]
        return pool.map(lambda job: job(), own, chunksize=1)


def _at(place: int):
    return lambda values: values[place]


def _read(session, path: str) -> DataFrame | None:
    """A table that was written whole, if there is one."""
    try:
        session.read.text(f"{path}/_SUCCESS").count()
        return session.read.parquet(path)
    except AnalysisException:
        return None
