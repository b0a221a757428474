"""Classification metrics and curves, computed inside Spark.

A metric table costs one aggregation. Curves are running totals over distinct scores, so they
need neither a collected prediction table nor a single-task sort. Every function takes ``keys``
(for example ``["model"]``) to handle many models in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.plans.ordered import running_totals

METRICS = ["accuracy", "precision", "recall", "f1_score", "auc_roc", "auc_pr"]


def stack_models(tables: dict[str, DataFrame]) -> DataFrame:
    """Prediction tables of several models in one, with a ``model`` column."""
    out = None
    for name, table in tables.items():
        tagged = table.withColumn("model", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction", keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction)."""
    return predictions.groupBy(*keys, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def confusion_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction", keys: Sequence[str] = ()
) -> DataFrame:
    """tn, tp, fn, fp and the four ratios; a ratio is null where its divisor is 0."""
    y, p = F.col(label), F.col(prediction)
    cells = predictions.groupBy(*keys).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
    )
    tn, tp, fn, fp = (F.col(c) for c in ("tn", "tp", "fn", "fp"))
    ratios = cells.withColumns(
        {
            "accuracy": F.try_divide(tn + tp, tn + tp + fn + fp),
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
        }
    )
    precision, recall = F.col("precision"), F.col("recall")
    return ratios.withColumn("f1_score", F.try_divide(2 * (precision * recall), precision + recall))


def curve_points(predictions: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, highest first: fpr, tpr, precision and recall at that threshold."""
    c = _cumulative(predictions, label, score, keys)
    tp, fp = F.col("run_pos"), F.col("run_neg")
    return c.select(
        *keys,
        F.col("_score").alias("threshold"),
        F.try_divide(fp, F.col("all_neg")).alias("fpr"),
        F.try_divide(tp, F.col("all_pos")).alias("tpr"),
        (tp / (tp + fp)).alias("precision"),
        F.try_divide(tp, F.col("all_pos")).alias("recall"),
    )


def roc_points(predictions: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """ROC curve from (0, 0) to (1, 1)."""
    return _from_origin(curve_points(predictions, label, score, keys), keys, {"fpr": 0.0, "tpr": 0.0})


def pr_points(predictions: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """Precision-recall curve, starting at recall 0 and precision 1."""
    return _from_origin(curve_points(predictions, label, score, keys), keys, {"recall": 0.0, "precision": 1.0})


def curve_areas(predictions: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """Trapezoid areas under both curves and the no-skill level of the precision-recall curve.

    The point before a row follows from the row's own totals, so no lag over the scores is needed.
    """
    c = _cumulative(predictions, label, score, keys)
    tp, fp = F.col("run_pos"), F.col("run_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    before = F.coalesce(F.try_divide(tp0, tp0 + fp0), F.lit(1.0))
    roc = F.try_divide(F.col("neg") * (tp + tp0), 2.0 * F.col("all_pos") * F.col("all_neg"))
    pr = F.try_divide(F.col("pos") * (before + tp / (tp + fp)), 2.0 * F.col("all_pos"))
    return c.groupBy(*keys).agg(
        F.sum(roc).alias("auc_roc"),
        F.sum(pr).alias("auc_pr"),
        (F.sum("pos") / F.sum(F.col("pos") + F.col("neg"))).alias("no_skill_pr"),
    )


def evaluator_area(predictions: DataFrame, metric: str, label: str = "label", score: str = "rawPrediction") -> float:
    """Area from the library evaluator, over all thresholds."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, metricName=metric, numBins=0).evaluate(predictions)


def metric_report(
    predictions: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    keys: Sequence[str] = ("model",),
    digits: int = 3,
) -> DataFrame:
    """All six metrics per key in long form: keys, ``metric``, ``value``."""
    ratios = confusion_metrics(predictions, label, prediction, keys)
    wide = ratios.join(curve_areas(predictions, label, score, keys), list(keys))
    rounded = wide.select(*keys, *[F.round(F.col(m).cast("double"), digits).alias(m) for m in METRICS])
    return rounded.unpivot(list(keys), METRICS, "metric", "value")


def metrics_by_model(report: DataFrame, models: Sequence[str]) -> DataFrame:
    """Metric table with one column per model."""
    return report.groupBy("metric").pivot("model", list(models)).agg(F.first("value"))


def _cumulative(predictions: DataFrame, label: str, score: str, keys: Sequence[str]) -> DataFrame:
    """Per distinct score: positives, negatives, their running totals from the top and their totals.

    Rows without a score (null or NaN) take no part.
    """
    group = list(keys) or ["_all"]
    rows = predictions if keys else predictions.withColumn("_all", F.lit(1))
    counts = (
        rows.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
        .groupBy(*group, F.col(score).cast("double").alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    return running_totals(counts, group, "_score", ["pos", "neg"], descending=True)


def _from_origin(points: DataFrame, keys: Sequence[str], start: dict[str, float]) -> DataFrame:
    columns = [*keys, "threshold", *start]
    blank = {c: F.lit(v) for c, v in start.items()} | {"threshold": F.lit(None).cast("double")}
    origin = points.select(*keys).distinct() if keys else points.agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    return points.select(*columns).unionByName(origin.withColumns(blank).select(*columns))
