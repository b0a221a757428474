"""Stacked classifiers: five base learners and a logistic regression over their outputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.functions.scalars import class_one_score
from churnloom.ml.stages import META_GRID, classifier, label_stage, preparation, vector_stages
from churnloom.ml.tune import PARALLELISM, Search, fit_prepared, grid_search
from churnloom.schema import KEY

BASE = ["lr", "rf", "gbt", "mlpc", "lsvc"]
META_PREDICTIONS = [f"pred_{n}" for n in BASE]
META_PROBABILITIES = ["prob_lr", "prob_rf", "prob_mlpc"]


def fit_base(train: DataFrame, names: Sequence[str] = BASE, inputs: str = "v2", parallelism: int = PARALLELISM) -> PipelineModel:
    """All base learners, each with its own output columns, fitted on the same prepared rows."""
    return fit_prepared(preparation(inputs), {n: classifier(n, inputs, private=True) for n in names}, train, parallelism)


def meta_features(base: PipelineModel, rows: DataFrame, with_gbt: bool = True, key: str = KEY) -> DataFrame:
    """Base predictions, probability vectors and the label of ``rows``; the booster's probability is carried along."""
    extra = ["prob_gbt"] if with_gbt else []
    return base.transform(rows).select(key, *META_PREDICTIONS, *META_PROBABILITIES, *extra, "label")


def meta_violations(meta: DataFrame, probabilities: Sequence[str] = (*META_PROBABILITIES, "prob_gbt")) -> DataFrame:
    """Per label: rows, predictions other than 0 and 1, probability vectors that are none, predictions of the less likely class."""
    wrong = [F.count_if(F.col(c).isNull() | ~F.col(c).isin(0.0, 1.0)) for c in META_PREDICTIONS]
    entries = {c: vector_to_array(F.col(c)) for c in probabilities}
    fair = {c: F.forall(v, lambda x: x.between(0, 1)) & (F.abs(F.aggregate(v, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9) for c, v in entries.items()}
    less = {c: F.when(F.col(c.replace("prob_", "pred_")) == 1, v[1] < v[0]).otherwise(v[1] > v[0]) for c, v in entries.items()}
    return meta.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        reduce(add, wrong).alias("bad_predictions"),
        reduce(add, [F.count_if(~F.coalesce(ok, F.lit(False))) for ok in fair.values()]).alias("bad_probabilities"),
        reduce(add, [F.count_if(F.coalesce(x, F.lit(True))) for x in less.values()]).alias("contradictions"),
    )


def meta_preparation() -> Pipeline:
    """Predictions as they are, probability vectors standardised."""
    return Pipeline(
        stages=[
            label_stage("label", "meta_label"),
            *vector_stages(META_PREDICTIONS, META_PROBABILITIES, target="meta_features"),
        ]
    )


def fit_meta(meta: DataFrame, axes: dict[str, Sequence] = META_GRID, **search) -> Search:
    """Grid search of the meta learner on the held-back validation rows."""
    learner = LogisticRegression(featuresCol="meta_features", labelCol="meta_label", predictionCol="meta_prediction")
    return grid_search(meta_preparation(), learner, axes, meta, label="meta_label", by="label", **search)


def stack_and_score(
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame,
    axes: dict[str, Sequence] = META_GRID,
    **search,
) -> tuple[PipelineModel, Search, DataFrame]:
    """Base learners on ``train``, meta learner on ``validation``, scores on ``test``."""
    base = fit_base(train)
    found = fit_meta(meta_features(base, validation), axes, **search)
    stacked = found.best.transform(meta_features(base, test))
    return (
        base,
        found,
        stacked.select(KEY, "meta_label", "meta_prediction", class_one_score("probability").alias("score")),
    )


def base_scores(base: PipelineModel, rows: DataFrame) -> DataFrame:
    """Label and prediction of every base learner, long form."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"pred_{n}").alias("prediction")) for n in BASE]))
    return base.transform(rows).select(KEY, "label", pairs.alias("p")).select(KEY, "label", "p.model", "p.prediction")
