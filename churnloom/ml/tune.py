"""Cross-validated grid search, spot checks and tuning runs."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from churnloom.functions.scalars import class_one_score
from churnloom.ml import boosting
from churnloom.ml.metrics import stack_models
from churnloom.ml.stages import SHORT_NAMES, SPOT_CHECK, WITH_PROBABILITY, classifier, param_maps, preparation
from churnloom.ml.trees import TREE_MODELS, fully_grown, prefix, shallower
from churnloom.operators.split import class_ranks
from churnloom.schema import KEY
from churnloom.session import checkpointed

#: fits that wait for their jobs at the same time
PARALLELISM = 12
KEEP = StorageLevel.MEMORY_AND_DISK
#: a kept table has at most one partition for so many rows: fits of small tables are all task overhead otherwise
ROWS_PER_PARTITION = 20_000


@dataclass
class Search:
    """Outcome of a grid search: one mean score per parameter map and the refitted best model."""

    maps: list[dict]
    scores: list[float]
    best: PipelineModel

    @property
    def best_params(self) -> dict[str, object]:
        return _named(self.maps[self.scores.index(max(self.scores))])

    def fitted_params(self) -> dict[str, object]:
        """The grid's parameters as the refitted model holds them."""
        model = self.best.stages[-1]
        return {name: model.getOrDefault(name) for name in self.best_params}

    def chosen(self, like: DataFrame) -> DataFrame:
        """The best point: parameter, value, score, and the number of points that score higher."""
        grid = self.table(like)
        best = grid.where(F.col("point") == self.scores.index(max(self.scores)))
        above = grid.groupBy("point").agg(F.first("score").alias("other"))
        higher = best.join(above, F.col("other") > F.col("score"), "left").groupBy("parameter", "value", best["score"])
        return higher.agg(F.count("other").alias("higher"))

    def table(self, like: DataFrame) -> DataFrame:
        """Grid points and their scores, long form (one row per point and parameter)."""
        rows = [
            (k, name, float(value), float(score))
            for k, (m, score) in enumerate(zip(self.maps, self.scores))
            for name, value in _named(m).items()
        ]
        return like.sparkSession.createDataFrame(rows, "point int, parameter string, value double, score double")


def with_folds(df: DataFrame, folds: int = 5, by: str = "churn", key: str = KEY) -> DataFrame:
    """Add ``fold``: every class is dealt out evenly, in digest order of the key."""
    return class_ranks(df, by, key).withColumn("fold", F.pmod(F.col("_rank"), F.lit(folds)).cast("int")).drop("_rank", "_size")


@dataclass
class PreparedFolds:
    """Training rows with their fold and unscaled inputs, kept once, and the scale of "all but this fold" for each fold."""

    train: DataFrame
    kept: DataFrame
    folds: int
    scaler: StandardScaler
    after: list[Transformer]
    scales: list[list[tuple[float, float]]]

    def pair(self, fold: int) -> tuple[DataFrame, DataFrame]:
        """(rows to fit on, held-out rows) of a fold, both scaled as the rows to fit on are."""
        entries = [(F.col(_CONT)[i] - mean) * scale for i, (mean, scale) in enumerate(self.scales[fold])]
        rows = self.kept.withColumn(self.scaler.getOutputCol(), array_to_vector(F.array(*entries)))
        for stage in self.after:
            rows = stage.transform(rows)
        rows = rows.drop(_CONT)
        return rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)


_CONT = "_unscaled"


@contextmanager
def prepared_folds(
    prepare: Pipeline,
    train: DataFrame,
    folds: int = 5,
    by: str = "churn",
    key: str = KEY,
    partitions: int | None = None,
) -> Iterator[PreparedFolds]:
    """The preparation of every fold from one kept table, for any number of searches.

    Only scaling depends on which rows are left out. Count, mean and squared deviations of each fold come from one
    aggregation; those of "all but fold k" are the other folds' put together, and scaling is an expression over the kept
    table. Labels are indexed over all training rows.

    The table is kept in memory or on disk until the block ends, however it ends. ``partitions`` sets
    how many partitions the kept rows have at most; without it they have those of ``train``'s own plan, but one for
    ROWS_PER_PARTITION rows at most. (Tree models depend on the partitioning of their input.) Partitions are put together
    from computed rows: a plan coalesced to few tasks would hold the sorts and joins of all of them in each.
    """
    stages = prepare.getStages()
    at = next(k for k, stage in enumerate(stages) if isinstance(stage, StandardScaler))
    scaler = stages[at]
    unscaled = Pipeline(stages=stages[:at]).fit(train).transform(with_folds(train, folds, by, key))
    unscaled = unscaled.withColumn(_CONT, vector_to_array(scaler.getInputCol()))
    # kept first, so that the checkpoint has the partitions and the order of a kept plan
    unscaled = unscaled.persist(KEEP)
    with ExitStack() as stored:
        try:
            rows = stored.enter_context(checkpointed(unscaled))
        finally:
            unscaled.unpersist()
        kept = rows.coalesce(partitions or _partitions(rows)).persist(KEEP)
        try:
            yield PreparedFolds(train, kept, folds, scaler, stages[at + 1 :], _scales(kept, folds))
        finally:
            kept.unpersist()


def _partitions(rows: DataFrame) -> int:
    return math.ceil(rows.count() / ROWS_PER_PARTITION) or 1


def _scales(kept: DataFrame, folds: int) -> list[list[tuple[float, float]]]:
    """For each fold, (mean, 1 / sample deviation) of every input over the other folds; 0 for an input that does not vary."""
    first = kept.select(F.size(_CONT)).first()
    width = first[0] if first else 0
    columns = [f(F.col(_CONT)[i]) for i in range(width) for f in (F.avg, F.var_pop)]
    moments = {r[0]: (r[1], r[2::2], r[3::2]) for r in kept.groupBy("fold").agg(F.count(F.lit(1)), *columns).collect()}
    out = []
    for fold in range(folds):
        others = [m for k, m in sorted(moments.items()) if k != fold]
        out.append([_scale([(n, means[i], variances[i]) for n, means, variances in others]) for i in range(width)])
    return out


def _scale(parts: list[tuple[int, float, float]]) -> tuple[float, float]:
    """(mean, 1 / sample deviation) of several groups, each given as (n, mean, variance)."""
    total, mean, squares = 0, 0.0, 0.0
    for n, m, v in parts:
        shift = m - mean
        squares += n * v + shift * shift * n * total / (n + total)
        mean += shift * n / (n + total)
        total += n
    deviation = math.sqrt(squares / (total - 1)) if total > 1 else 0.0
    return mean, 1 / deviation if deviation else 0.0


def grid_search(
    prepare: Pipeline,
    estimator: Estimator,
    axes: dict[str, Sequence],
    train: DataFrame,
    folds: int = 5,
    parallelism: int = PARALLELISM,
    partitions: int | None = None,
    label: str = "label",
    by: str = "churn",
    key: str = KEY,
) -> Search:
    """Grid search by cross validation on the exact area under the ROC curve.

    The preparation of all folds comes from one kept table and is shared by all grid
    points. Fits of all folds and points run ``parallelism`` at a time.
    """
    with prepared_folds(prepare, train, folds, by, key, partitions) as data:
        return search_folds(data, prepare, estimator, axes, parallelism, label)


def search_folds(
    data: PreparedFolds, prepare: Pipeline, estimator: Estimator, axes: dict[str, Sequence], parallelism: int = PARALLELISM, label: str = "label"
) -> Search:
    """Grid search over folds that are prepared already.

    Every point of the grid is scored. Points whose fits are equal by construction share one:

    * those that differ only in a step size the solver does not use, or in the mixture of a penalty of 0;
    * for a logistic regression or a perceptron that has converged within its iteration limit, those with a higher limit;
    * for boosted trees, those that differ in the number of steps: the first trees of the longest
      ensemble are the shorter one (fits of all folds and points are grown side by side, see ``boosting``);
    * for a forest, those with a lower depth limit, which are the deepest one cut there;
    * for other trees that are fully grown within their depth limit, those with a higher limit.
    """
    maps = param_maps(estimator, axes)
    estimator = _short_lineage(estimator)
    score = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=estimator.getRawPredictionCol(), numBins=0)
    totals = [0.0] * len(maps)

    def forest_areas(at: tuple[int, list[int]]) -> dict[int, float]:
        fit_on, check_on = pairs[at[0]]
        *lower, deepest = _levels(estimator, maps, at[1])
        models = {deepest[-1]: estimator.fit(fit_on, maps[deepest[-1]])}
        cut = shallower(models[deepest[-1]], [_named(maps[level[-1]])["maxDepth"] for level in lower]) if lower else {}
        for level in lower:
            limit = _named(maps[level[-1]])["maxDepth"]
            models[level[-1]] = cut[limit] if limit in cut else estimator.fit(fit_on, maps[level[-1]])
        known = {id(model): score.evaluate(model.transform(check_on)) for model in {id(m): m for m in models.values()}.values()}
        return {k: known[id(models[level[-1]])] for level in [*lower, deepest] for k in level}

    def areas(at: tuple[int, list[int]]) -> dict[int, float]:
        if isinstance(estimator, RandomForestClassifier):
            return forest_areas(at)
        (fit_on, check_on), out = pairs[at[0]], {}
        model, limit, known = None, None, {}
        for level in _levels(estimator, maps, at[1]):
            longest = level[-1]
            mine = _named(maps[longest])
            if model is None or not _same_when_raised(model, limit, mine):
                model, limit, known = estimator.fit(fit_on, maps[longest]), mine, {}
            for k in level:
                steps = _named(maps[k]).get("maxIter")
                if steps not in known:
                    shorter = prefix(model, steps) if isinstance(model, GBTClassificationModel) else model
                    known[steps] = score.evaluate(shorter.transform(check_on))
                out[k] = known[steps]
        return out

    def boosted_areas() -> list[dict[int, float]]:
        points = [{n: estimator.getOrDefault(n) for n in boosting.AXES} | _named(m) for m in maps]
        fit_of = lambda fold, p: boosting.Fit(fold, p["maxDepth"], p["maxBins"], p["stepSize"])
        fits = list(dict.fromkeys(fit_of(fold, p) for fold in range(data.folds) for p in points))
        by_margin = score.copy().setLabelCol("label").setRawPredictionCol("margin")
        parts = [max(1, check_on.rdd.getNumPartitions()) for _, check_on in pairs]
        known = {}
        for steps, table in boosting.margins(estimator, fits, pairs, label, sorted({p["maxIter"] for p in points})):
            wanted = sorted({fits.index(fit_of(fold, p)) for fold in range(data.folds) for p in points if p["maxIter"] == steps})
            table = table.persist(KEEP)
            try:
                # in as many partitions as the held-out rows have, since an area is summed by partition
                found = _in_parallel(lambda k: by_margin.evaluate(table.where(F.col("fit") == k).coalesce(parts[fits[k].fold])), wanted, parallelism)  # noqa: B023
            finally:
                table.unpersist()
            known |= {(fits[k], steps): value for k, value in zip(wanted, found, strict=True)}
        return [{k: known[fit_of(fold, p), p["maxIter"]] for k, p in enumerate(points)} for fold in range(data.folds)]

    tasks = [(fold, group) for fold in range(data.folds) for group in _alike(estimator, maps)]
    columns = [estimator.getFeaturesCol(), label]
    with ExitStack() as stored:
        # every job of a fit carries the plan of its rows along, so they are computed before
        store = lambda fold: tuple(stored.enter_context(checkpointed(rows.select(*columns))) for rows in data.pair(fold))
        pairs = [store(fold) for fold in range(data.folds)]
        side_by_side = boosting.plain(estimator) and set(axes) <= boosting.AXES
        results = boosted_areas() if side_by_side else _in_parallel(areas, tasks, parallelism)
    for found in results:
        for k, value in found.items():
            totals[k] += value
    scores = [total / data.folds for total in totals]
    best = fit_prepared(prepare, {"best": estimator.copy(maps[scores.index(max(scores))])}, data.train, parallelism)
    return Search(maps, scores, best)


def fit_prepared(prepare: Pipeline, estimators: dict[str, Estimator], train: DataFrame, parallelism: int = PARALLELISM) -> PipelineModel:
    """Fit the preparation, then all estimators side by side on the prepared rows; one model in sequence."""
    stages = prepare.fit(train)
    with checkpointed(stages.transform(train)) as rows:
        prepared = rows.coalesce(_partitions(rows)).persist(KEEP)
        try:
            models: list[Model] = _in_parallel(lambda e: e.fit(prepared), [_short_lineage(e) for e in estimators.values()], parallelism)
        finally:
            prepared.unpersist()
    return PipelineModel([*stages.stages, *models])


def tune(
    name: str, axes: dict[str, Sequence], train: DataFrame, test: DataFrame, inputs: str = "v2", **search
) -> tuple[Search, DataFrame]:
    """Search one classifier's grid on ``train``; return the search and the scored ``test`` rows."""
    found = grid_search(preparation(inputs), classifier(name, inputs), axes, train, **search)
    return found, scored(found.best.transform(test), name)


def spot_check(
    train: DataFrame,
    test: DataFrame,
    grids: dict[str, dict[str, Sequence]] = SPOT_CHECK,
    names: Sequence[str] = SHORT_NAMES,
    inputs: str = "v2",
    **search,
) -> tuple[dict[str, Search], DataFrame]:
    """Fit every classifier at its spot-check point; score both the training and the held-out rows.

    The scored table has ``model``, ``split``, ``label``, ``prediction``, ``score``.
    """
    found: dict[str, Search] = {}
    tables = {}
    prepare, parallelism = preparation(inputs), search.pop("parallelism", PARALLELISM)
    with prepared_folds(prepare, train, **search) as data:
        for name in names:
            found[name] = search_folds(data, prepare, classifier(name, inputs), grids[name], parallelism)
            both = [
                scored(found[name].best.transform(rows), name).withColumn("split", F.lit(split))
                for split, rows in (("train", train), ("test", test))
            ]
            tables[name] = both[0].unionByName(both[1])
    return found, stack_models(tables)


def scored(predictions: DataFrame, name: str, key: str = KEY) -> DataFrame:
    """Key, label, prediction and the score of class 1 (probability, or margin where there is none)."""
    vector = "probability" if name in WITH_PROBABILITY else "rawPrediction"
    return predictions.select(key, "label", "prediction", class_one_score(vector).alias("score"))


def _short_lineage(estimator: Estimator) -> Estimator:
    """Others as they are, but for what each of their many jobs carries along.

    A booster cuts the lineage of its residuals after every tree. The rows of a forest keep the node they have come to: else every
    level sends all trees grown so far, and every row walks down each of them again. Neither changes a tree.
    """
    if isinstance(estimator, RandomForestClassifier):
        return estimator.copy().setCacheNodeIds(True)
    return estimator.copy().setCheckpointInterval(1) if isinstance(estimator, GBTClassifier) else estimator


def _limits(estimator: Estimator) -> tuple[str, ...]:
    """Parameters that only end a fit: raising them may leave it as it is."""
    return {
        LogisticRegression: ("maxIter",),
        MultilayerPerceptronClassifier: ("maxIter",),
        DecisionTreeClassifier: ("maxDepth",),
        RandomForestClassifier: ("maxDepth",),
        GBTClassifier: ("maxDepth", "maxIter"),
    }.get(type(estimator), ())


def _unused(estimator: Estimator, point: dict) -> set[str]:
    """Parameters that play no part in the fit at a point: a step size L-BFGS does not take, the mixture of a penalty of 0."""
    if isinstance(estimator, MultilayerPerceptronClassifier) and estimator.getSolver() == "l-bfgs":
        return {"stepSize"}
    if isinstance(estimator, LogisticRegression) and point.get("regParam", estimator.getRegParam()) == 0:
        return {"elasticNetParam"}
    return set()


def _alike(estimator: Estimator, maps: list[dict]) -> list[list[int]]:
    """Indices of maps that agree in all but limits and unused parameters."""
    groups: dict[tuple, list[int]] = {}
    for k, m in enumerate(maps):
        point = _named(m)
        apart = {*_limits(estimator), *_unused(estimator, point)}
        groups.setdefault(tuple(sorted((n, v) for n, v in point.items() if n not in apart)), []).append(k)
    return list(groups.values())


def _levels(estimator: Estimator, maps: list[dict], group: list[int]) -> list[list[int]]:
    """Maps of a group that one fit may serve, the one to fit last; levels from the lowest limit up."""
    shared = "maxIter" if isinstance(estimator, GBTClassifier) else None
    names = [n for n in _limits(estimator) if n != shared]
    levels: dict[tuple, list[int]] = {}
    for k in group:
        levels.setdefault(tuple(_named(maps[k]).get(n, 0) for n in names), []).append(k)
    return [sorted(levels[v], key=lambda k: _named(maps[k]).get(shared, 0)) for v in sorted(levels)]


def _same_when_raised(model: Model, limit: dict, mine: dict) -> bool:
    """Whether a fit that ended within ``limit`` is also the fit for the higher limits ``mine``."""
    if isinstance(model, LogisticRegressionModel):
        same = limit.get("maxIter") == mine.get("maxIter")
        return same or model.hasSummary and model.summary.totalIterations < model.getMaxIter()
    if isinstance(model, MultilayerPerceptronClassificationModel):
        return limit.get("maxIter") == mine.get("maxIter") or model.hasSummary and model.summary().totalIterations < model.getMaxIter()
    if isinstance(model, TREE_MODELS):
        return limit.get("maxDepth") == mine.get("maxDepth") or fully_grown(model, limit["maxDepth"])
    return True


def _in_parallel(task, items: Sequence, parallelism: int) -> list:
    if len(items) == 1 or parallelism == 1:
        return [task(i) for i in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(task), items)


def _named(param_map: dict) -> dict[str, object]:
    return {p.name: v for p, v in param_map.items()}
