"""Queries over model inputs, trained classifiers and prediction tables."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.ml import certificates as C
from churnloom.ml import metrics as M
from churnloom.ml.stacking import base_scores, fit_base, meta_features, meta_violations, stack_and_score
from churnloom.ml.stages import META_GRID, SHORT_NAMES, SPOT_CHECK, TUNE_V1_SAMPLE, TUNE_V2_SAMPLE, classifier, param_maps, preparation
from churnloom.ml.trees import tree_nodes
from churnloom.ml.tune import scored, spot_check, tune, with_folds
from churnloom.operators.split import THREE_WAY_SAMPLE, TRAIN_TEST, parts, stratified_split
from churnloom.queries.common import split_cte, sql_features, sql_features_v1, stored_features, tidy, v1_features
from churnloom.schema import BINARY_V1, BINARY_V2, CONTINUOUS_V1, CONTINUOUS_V2, KEY
from churnloom.session import cut_lineage

DIGITS = 6


# ---- model inputs ----------------------------------------------------------------------------


def _prepared(features: DataFrame, inputs: str) -> DataFrame:
    return preparation(inputs).fit(features).transform(features)


def _entries(prepared: DataFrame, vector: str) -> DataFrame:
    """One row per (user, position) of a vector column."""
    return prepared.select(KEY, F.posexplode(vector_to_array(vector)).alias("position", "value"))


def _inputs(inputs, build):
    def query(spark, sf_dir):
        features = stored_features(spark, sf_dir) if inputs == "v2" else cut_lineage(v1_features(spark, sf_dir), "features")
        return tidy(build(_prepared(features, inputs)))

    return query


# ---- prediction tables with a fixed score, for the metric operators ---------------------------


def _two_models(features: DataFrame) -> DataFrame:
    """Two scores worked out from the counters, as stand-ins for two models."""
    of = {
        "dislikes": F.col("nr_dislikes") / (F.col("nr_likes") + F.col("nr_dislikes") + 1),
        "errors": F.col("nr_error") / (F.col("n_acts") + 1),
    }
    base = features.withColumn("label", F.col("churn").cast("double"))
    return M.stack_models(
        {
            name: base.select(KEY, "label", (score >= 0.5).cast("double").alias("prediction"), score.alias("score"))
            for name, score in of.items()
        }
    )


def _metric(build):
    return lambda spark, sf_dir: tidy(build(_two_models(stored_features(spark, sf_dir))))


def _one_model(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("model") == "dislikes").drop("model")


def _evaluator_areas(spark, sf_dir):
    rows = []
    scored = cut_lineage(_two_models(stored_features(spark, sf_dir)), "scored")
    for model in ("dislikes", "errors"):
        one = scored.where(F.col("model") == model)
        rows.append((model, *(M.evaluator_area(one, m, score="score") for m in ("areaUnderROC", "areaUnderPR"))))
    return tidy(spark.createDataFrame(rows, "model string, auc_roc double, auc_pr double"))


# ---- trained models --------------------------------------------------------------------------


def _train_test(spark, sf_dir, features=stored_features):
    split = cut_lineage(stratified_split(features(spark, sf_dir)), "split")
    return parts(split, ["train", "test"])


def _spot_check(name):
    def query(spark, sf_dir):
        made = _train_test(spark, sf_dir)
        _, predictions = spot_check(made["train"], made["test"], SPOT_CHECK, [name])
        return tidy(predictions)

    return query


def _all_models(spark, sf_dir):
    """Scores of all six classifiers on both splits, stored."""
    made = _train_test(spark, sf_dir)
    _, predictions = spot_check(made["train"], made["test"])
    return cut_lineage(predictions, "predictions")


def _models_compared(spark, sf_dir):
    """Metrics by model on the held-out rows, as trained."""
    held_out = _all_models(spark, sf_dir).where(F.col("split") == "test")
    return tidy(M.metrics_by_model(M.metric_report(held_out), SHORT_NAMES))


def _checked(predictions, *keys):
    """Per key and label: rows, and rows that no classifier may give.

    Predictions other than 0 and 1, scores that are missing or (probabilities) outside [0, 1], and
    predictions that contradict their score.
    """
    p, score = F.col("prediction"), F.col("score")
    margin = F.col("model") == "lsvc" if "model" in predictions.columns else F.lit(False)
    cut = F.when(margin, 0.0).otherwise(0.5)
    return predictions.groupBy(*keys, "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(p.isNull() | ~p.isin(0.0, 1.0)).alias("bad_predictions"),
        F.count_if(score.isNull() | F.isnan(score) | (~margin & ~score.between(0, 1))).alias("bad_scores"),
        F.count_if((score != cut) & ((score > cut) != (p == 1))).alias("contradictions"),
    )


def _models_checked(spark, sf_dir):
    return tidy(_checked(_all_models(spark, sf_dir), "model", "split"))


def once_per_session(run):
    """Outcome of ``run(spark, sf_dir, name)``, worked out by the first row that asks for it.

    Report, grid, check and best-point rows of a model describe one training run. Kept are the grid with its scores,
    the fitted model, and a stored table of scored rows.
    """
    kept = {}

    def found(spark, sf_dir, name):
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in kept:
            search, predictions = run(spark, sf_dir, name)
            kept[key] = search, cut_lineage(predictions, "scored")
        return kept[key]

    return found


@once_per_session
def _tuned_v1(spark, sf_dir, name):
    made = _train_test(spark, sf_dir, lambda s, d: cut_lineage(v1_features(s, d), "features"))
    return tune(name, TUNE_V1_SAMPLE[name], made["train"], made["test"], "v1")


@once_per_session
def _tuned_v2(spark, sf_dir, name):
    made = _train_test(spark, sf_dir)
    return tune(name, TUNE_V2_SAMPLE[name], made["train"], made["test"])


def _tuned_report(run, name):
    def query(spark, sf_dir):
        _, predictions = run(spark, sf_dir, name)
        return tidy(M.metric_report(predictions.withColumn("model", F.lit(name))))

    return query


def _tuned_grid(run, name):
    def query(spark, sf_dir):
        found, predictions = run(spark, sf_dir, name)
        return tidy(found.table(predictions))

    return query


def _grid_checked(run, name):
    """How many points of the grid have each value of a parameter, and how many of their scores are no areas."""

    def query(spark, sf_dir):
        found, predictions = run(spark, sf_dir, name)
        table = found.table(predictions)
        return tidy(table.groupBy("parameter", "value").agg(F.count(F.lit(1)).alias("points"), F.count_if(~F.col("score").between(0, 1)).alias("bad_scores")))

    return query


def _tuned_best(run, name):
    """The chosen point of the grid: its parameters, its mean score, and how many points score higher."""

    def query(spark, sf_dir):
        found, predictions = run(spark, sf_dir, name)
        return tidy(found.chosen(predictions))

    return query


def _best_checked(run, name):
    """Per chosen parameter: whether the grid has its value, and whether another point beats the chosen one."""

    def query(spark, sf_dir):
        found, predictions = run(spark, sf_dir, name)
        grid, best = found.table(predictions), found.chosen(predictions)
        listed = grid.select("parameter", "value").distinct().withColumn("listed", F.lit(1))
        fitted = spark.createDataFrame([(n, float(v)) for n, v in found.fitted_params().items()], "parameter string, fitted double")
        joined = best.join(listed, ["parameter", "value"], "left").join(fitted, "parameter", "left")
        return joined.select(
            "parameter",
            F.coalesce("listed", F.lit(0)).alias("listed"),
            F.col("higher").cast("bigint").alias("higher"),
            F.coalesce(F.col("fitted") == F.col("value"), F.lit(False)).alias("fitted"),
        )

    return query


# ---- certificates: zeros for a model that fits its training rows -------------------------------


def _fitted(spark, sf_dir, name):
    """Spot-check classifier, the prepared rows it was fitted on, and their scores."""
    train = _train_test(spark, sf_dir)["train"]
    stages = preparation().fit(train)
    rows = cut_lineage(stages.transform(train).select(KEY, "label", "features"), "prepared")
    (point,) = param_maps(learner := classifier(name), SPOT_CHECK[name])
    model = learner.fit(rows, point)
    return model, rows, scored(model.transform(rows), name)


def _tree_certificate(name, build):
    def query(spark, sf_dir):
        model, rows, scores = _fitted(spark, sf_dir, name)
        nodes, trees = tree_nodes(model), 1 if name == "dt" else model.getNumTrees
        reached = C.reached_leaves(rows, nodes, SPOT_CHECK[name]["maxDepth"][0], trees)
        table = build(reached, nodes, model, scores)
        # node and tree numbers stay as the model has them
        return tidy(table).withColumns({c: F.col(c).cast(kind) for c, kind in table.dtypes if kind == "int"})

    return query


def _lr_certificate(spark, sf_dir):
    """Slopes of the tuned logistic regression on the rows it was refitted on, to three digits."""
    found, _ = _tuned_v1(spark, sf_dir, "lr")
    train = _train_test(spark, sf_dir, lambda s, d: cut_lineage(v1_features(s, d), "features"))["train"]
    *stages, model = found.best.stages
    rows = PipelineModel(stages).transform(train)
    slopes = C.logistic_violations(rows, model.coefficients.toArray().tolist(), model.intercept, model.getRegParam(), model.getElasticNetParam())
    return slopes.select("position", (F.round("violation", 3) + 0).alias("violation"))


def _three_ways(spark, sf_dir):
    split = cut_lineage(stratified_split(stored_features(spark, sf_dir), THREE_WAY_SAMPLE), "split")
    return parts(split, list(THREE_WAY_SAMPLE))


def _base_predictions(spark, sf_dir):
    made = _three_ways(spark, sf_dir)
    return tidy(base_scores(fit_base(made["train"]), made["validation"]))


def _meta_features(spark, sf_dir):
    made = _three_ways(spark, sf_dir)
    table = meta_features(fit_base(made["train"]), made["validation"])
    vectors = [c for c in table.columns if c.startswith("prob_")]
    return tidy(table.select(KEY, "label", *[c for c in table.columns if c.startswith("pred_")], *[vector_to_array(c)[1].alias(c) for c in vectors]))


def _meta_checked(spark, sf_dir):
    """Per label: rows of the meta table, and entries that no base learner may give."""
    made = _three_ways(spark, sf_dir)
    table = meta_features(fit_base(made["train"]), made["validation"])
    return tidy(meta_violations(table, [c for c in table.columns if c.startswith("prob_")]))


@once_per_session
def _stacked_search(spark, sf_dir, name):
    made = _three_ways(spark, sf_dir)
    _, found, predictions = stack_and_score(made["train"], made["validation"], made["test"])
    return found, predictions.withColumnsRenamed({"meta_label": "label", "meta_prediction": "prediction"})


def _stacked_run(spark, sf_dir, name="meta"):
    return _stacked_search(spark, sf_dir, name)


def _stacked(spark, sf_dir):
    _, predictions = _stacked_run(spark, sf_dir)
    return tidy(predictions.withColumnsRenamed({"label": "meta_label", "prediction": "meta_prediction"}))


def _stacked_curves(spark, sf_dir):
    _, predictions = _stacked_run(spark, sf_dir)
    return tidy(M.curve_points(predictions))


def _stacked_checked(spark, sf_dir):
    _, predictions = _stacked_run(spark, sf_dir)
    return tidy(_checked(predictions))


def _base_checked(spark, sf_dir):
    made = _three_ways(spark, sf_dir)
    rows = base_scores(fit_base(made["train"]), made["validation"])
    bad = F.count_if(F.col("prediction").isNull() | ~F.col("prediction").isin(0.0, 1.0))
    return tidy(rows.groupBy("model", "label").agg(F.count(F.lit(1)).alias("n"), bad.alias("bad_predictions")))


_KINDS = {"report": _tuned_report, "grid": _tuned_grid, "checked": _grid_checked, "best": _tuned_best, "best_checked": _best_checked}

QUERIES = {
    # inputs
    "label_index": _inputs("v2", lambda p: p.select(KEY, "churn", "label")),
    "binary_vector": _inputs("v1", lambda p: _entries(p, "bin_features")),
    "continuous_vector": _inputs("v2", lambda p: _entries(p, "cont_features")),
    "scaled_vector": _inputs("v2", lambda p: _entries(p, "cont_scaler")),
    "final_vector_v2": _inputs("v2", lambda p: _entries(p, "features")),
    "final_vector_v1": _inputs("v1", lambda p: _entries(p, "features")),
    "folds": lambda spark, sf_dir: tidy(with_folds(stored_features(spark, sf_dir)).select(KEY, "churn", "fold")),
    # metrics on given scores
    "confusion_matrix": _metric(lambda p: M.confusion(p, keys=["model"])),
    "confusion_metrics": _metric(lambda p: M.confusion_metrics(p, keys=["model"])),
    "roc_curve": _metric(lambda p: M.roc_points(_one_model(p))),
    "pr_curve": _metric(lambda p: M.pr_points(_one_model(p))),
    "curve_comparison": _metric(lambda p: M.curve_points(p, keys=["model"])),
    "curve_areas": _metric(lambda p: M.curve_areas(p, keys=["model"])),
    "evaluator_areas": _evaluator_areas,
    "metric_report": _metric(M.metric_report),
    "metrics_by_model": _metric(lambda p: M.metrics_by_model(M.metric_report(p), ["dislikes", "errors"])),
    # trained models
    **{f"spot_check_{name}": _spot_check(name) for name in SHORT_NAMES},
    "models_compared": _models_compared,
    "models_checked": _models_checked,
    **{f"tuned_v1_{name}_{kind}": make(_tuned_v1, name) for name in TUNE_V1_SAMPLE if name != "lr" for kind, make in _KINDS.items()},
    **{f"tuned_{name}_{kind}": _KINDS[kind](_tuned_v2, name) for name in ("mlpc", "gbt") for kind in ("best", "best_checked")},
    **{f"tuned_lr_{kind}": _KINDS[kind](_tuned_v1, "lr") for kind in ("best", "best_checked")},
    "tuned_gbt_checked": _grid_checked(_tuned_v2, "gbt"),
    "lr_certificate": _lr_certificate,
    "dt_certificate": _tree_certificate("dt", lambda reached, nodes, model, scores: C.leaf_recount(reached, nodes)),
    "rf_certificate": _tree_certificate("rf", lambda reached, nodes, model, scores: C.vote_errors(reached, scores)),
    "gbt_certificate": _tree_certificate("gbt", lambda reached, nodes, model, scores: C.residual_errors(reached, model.treeWeights)),
    "stacked_best": _tuned_best(_stacked_run, "meta"),
    "stacked_best_checked": _best_checked(_stacked_run, "meta"),
    "tuned_lr_report": _tuned_report(_tuned_v1, "lr"),
    "tuned_lr_grid": _tuned_grid(_tuned_v1, "lr"),
    "tuned_lr_checked": _grid_checked(_tuned_v1, "lr"),
    **{f"tuned_{name}_report": _tuned_report(_tuned_v2, name) for name in ("mlpc", "gbt")},
    **{f"tuned_{name}_grid": _tuned_grid(_tuned_v2, name) for name in ("mlpc", "gbt")},
    "tuned_mlpc_checked": _grid_checked(_tuned_v2, "mlpc"),
    "stacked_report": _tuned_report(_stacked_run, "meta"),
    "stacked_grid": _tuned_grid(_stacked_run, "meta"),
    "stacked_grid_checked": _grid_checked(_stacked_run, "meta"),
    "stacked_curves": _stacked_curves,
    "stacked_checked": _stacked_checked,
    "base_checked": _base_checked,
    "base_predictions": _base_predictions,
    "meta_features": _meta_features,
    "meta_checked": _meta_checked,
    "stacked_scores": _stacked,
}


# ---- the same questions in SQL ---------------------------------------------------------------


def _entries_sql(raw, scaled, build, scaled_only=False, raw_only=False, plain=False):
    parts_, position = [], 0
    if not scaled_only:
        for c in raw:
            parts_.append(f'SELECT "userId", CAST({position} AS BIGINT) AS position, CAST({c} AS DOUBLE) AS value FROM feat')
            position += 1
    if not raw_only:
        for c in scaled:
            value = (
                f"CAST({c} AS DOUBLE)"
                if plain
                else f"CASE WHEN stddev_samp({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () ELSE 0 END"
            )
            parts_.append(f'SELECT "userId", CAST({position} AS BIGINT) AS position, {value} AS value FROM feat')
            position += 1
    return build(f'SELECT "userId", position, round(value, {DIGITS}) + 0 AS value FROM (' + " UNION ALL ".join(parts_) + ")")


_SCORED = """scored AS (
  SELECT 'dislikes' AS model, CAST(churn AS DOUBLE) AS label, CAST(nr_dislikes AS DOUBLE) / (nr_likes + nr_dislikes + 1) AS score FROM feat
  UNION ALL
  SELECT 'errors' AS model, CAST(churn AS DOUBLE) AS label, CAST(nr_error AS DOUBLE) / (n_acts + 1) AS score FROM feat
),
predicted AS (SELECT *, CASE WHEN score >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM scored),
cells AS (
  SELECT model, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp
  FROM predicted GROUP BY model
),
ratios AS (
  SELECT *, CAST(tn + tp AS DOUBLE) / nullif(tn + tp + fn + fp, 0) AS accuracy, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS "precision",
    CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall FROM cells
),
confused AS (SELECT *, 2 * ("precision" * recall) / nullif("precision" + recall, 0) AS f1_score FROM ratios),
steps AS (
  SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY ALL
),
running AS (
  SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
    CAST(sum(pos) OVER (PARTITION BY model) AS DOUBLE) AS p, CAST(sum(neg) OVER (PARTITION BY model) AS DOUBLE) AS n
  FROM steps WINDOW w AS (PARTITION BY model ORDER BY score DESC)
),
curve AS (SELECT model, score, pos, neg, p, n, fp / n AS fpr, tp / p AS tpr, tp / (tp + fp) AS prec FROM running),
lagged AS (
  SELECT *, lag(tpr) OVER w AS tpr0, lag(fpr) OVER w AS fpr0, lag(prec) OVER w AS prec0
  FROM curve WINDOW w AS (PARTITION BY model ORDER BY score DESC)
),
areas AS (
  SELECT model, sum((fpr - coalesce(fpr0, 0)) * (tpr + coalesce(tpr0, 0)) / 2) AS auc_roc,
    sum((tpr - coalesce(tpr0, 0)) * (prec + coalesce(prec0, 1)) / 2) AS auc_pr,
    sum((tpr - coalesce(tpr0, 0)) * (prec + coalesce(prec0, prec)) / 2) AS evaluator_pr,
    CAST(sum(pos) AS DOUBLE) / sum(pos + neg) AS no_skill_pr
  FROM lagged GROUP BY model
),
report AS (
  SELECT model, unnest(['accuracy', 'precision', 'recall', 'f1_score', 'auc_roc', 'auc_pr']) AS metric,
    unnest([round(accuracy, 3), round("precision", 3), round(recall, 3), round(f1_score, 3), round(auc_roc, 3), round(auc_pr, 3)]) AS value
  FROM confused JOIN areas USING (model)
)"""


def _metric_sql(select):
    return sql_features(select, _SCORED)


def _grid_sql(axes):
    """What ``checked`` gives for a whole grid: every axis meets all values of the others."""
    size = math.prod(len(values) for values in axes.values())
    return _points_sql(*[(name, size // len(values), values) for name, values in axes.items()])


def _best_sql(axes):
    """One row per parameter of the grid: a listed value, the one of the fitted model, and no point that scores higher."""
    rows = ", ".join(f"('{name}')" for name in axes)
    return f"SELECT parameter, 1 AS listed, CAST(0 AS BIGINT) AS higher, true AS fitted FROM (VALUES {rows}) g(parameter)"


def _points_sql(*lines):
    """Rows of (parameter, value, points)."""
    rows = ", ".join(f"('{p}', CAST({v} AS DOUBLE), CAST({n} AS BIGINT))" for p, n, values in lines for v in values)
    return f"SELECT parameter, value, points, CAST(0 AS BIGINT) AS bad_scores FROM (VALUES {rows}) g(parameter, value, points)"


_ZEROS = "CAST(0 AS BIGINT) AS bad_predictions, CAST(0 AS BIGINT) AS bad_scores, CAST(0 AS BIGINT) AS contradictions"
_LABELS = "CAST(churn AS DOUBLE) AS label, count(*) AS n"

_POINT = f"round(score, {DIGITS}) AS threshold"

ORACLES = {
    "label_index": sql_features('SELECT "userId", churn, CAST(churn AS DOUBLE) AS label FROM feat'),
    "binary_vector": _entries_sql(BINARY_V1, CONTINUOUS_V1, sql_features_v1, raw_only=True),
    "continuous_vector": _entries_sql(BINARY_V2, CONTINUOUS_V2, sql_features, scaled_only=True, plain=True),
    "scaled_vector": _entries_sql(BINARY_V2, CONTINUOUS_V2, sql_features, scaled_only=True),
    "final_vector_v2": _entries_sql(BINARY_V2, CONTINUOUS_V2, sql_features),
    "final_vector_v1": _entries_sql(BINARY_V1, CONTINUOUS_V1, sql_features_v1),
    "folds": sql_features(
        """SELECT "userId", churn, row_number() OVER (PARTITION BY churn ORDER BY md5('1234:' || "userId") || ':' || "userId") % 5
        AS fold FROM feat"""
    ),
    "confusion_matrix": _metric_sql("SELECT model, label, prediction, count(*) AS n FROM predicted GROUP BY ALL"),
    "confusion_metrics": _metric_sql(
        f"""SELECT model, tn, tp, fn, fp, round(accuracy, {DIGITS}) AS accuracy, round("precision", {DIGITS}) AS "precision",
        round(recall, {DIGITS}) AS recall, round(f1_score, {DIGITS}) AS f1_score FROM confused"""
    ),
    "roc_curve": _metric_sql(
        f"""SELECT {_POINT}, round(fpr, {DIGITS}) AS fpr, round(tpr, {DIGITS}) AS tpr FROM curve WHERE model = 'dislikes'
        UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)"""
    ),
    "pr_curve": _metric_sql(
        f"""SELECT {_POINT}, round(tpr, {DIGITS}) AS recall, round(prec, {DIGITS}) AS "precision" FROM curve WHERE model = 'dislikes'
        UNION ALL SELECT CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)"""
    ),
    "curve_comparison": _metric_sql(
        f"""SELECT model, {_POINT}, round(fpr, {DIGITS}) AS fpr, round(tpr, {DIGITS}) AS tpr, round(prec, {DIGITS}) AS "precision",
        round(tpr, {DIGITS}) AS recall FROM curve"""
    ),
    "curve_areas": _metric_sql(
        f"""SELECT model, round(auc_roc, {DIGITS}) AS auc_roc, round(auc_pr, {DIGITS}) AS auc_pr,
        round(no_skill_pr, {DIGITS}) AS no_skill_pr FROM areas"""
    ),
    "evaluator_areas": _metric_sql(
        f"SELECT model, round(auc_roc, {DIGITS}) AS auc_roc, round(evaluator_pr, {DIGITS}) AS auc_pr FROM areas"
    ),
    "metric_report": _metric_sql("SELECT model, metric, value FROM report"),
    "metrics_by_model": _metric_sql(
        """SELECT metric, max(value) FILTER (WHERE model = 'dislikes') AS dislikes, max(value) FILTER (WHERE model = 'errors') AS errors
        FROM report GROUP BY metric"""
    ),
    "models_checked": sql_features(
        f"""SELECT model, split, {_LABELS}, {_ZEROS} FROM split, (SELECT unnest(['lr', 'dt', 'rf', 'gbt', 'mlpc', 'lsvc']) AS model)
        GROUP BY model, split, churn""",
        split_cte(TRAIN_TEST),
    ),
    "base_checked": sql_features(
        f"""SELECT model, {_LABELS}, CAST(0 AS BIGINT) AS bad_predictions
        FROM split, (SELECT unnest(['lr', 'rf', 'gbt', 'mlpc', 'lsvc']) AS model) WHERE split = 'validation' GROUP BY model, churn""",
        split_cte(THREE_WAY_SAMPLE),
    ),
    "meta_checked": sql_features(
        f"""SELECT {_LABELS}, CAST(0 AS BIGINT) AS bad_predictions, CAST(0 AS BIGINT) AS bad_probabilities, CAST(0 AS BIGINT) AS contradictions
        FROM split WHERE split = 'validation' GROUP BY churn""",
        split_cte(THREE_WAY_SAMPLE),
    ),
    "stacked_checked": sql_features(f"SELECT {_LABELS}, {_ZEROS} FROM split WHERE split = 'test' GROUP BY churn", split_cte(THREE_WAY_SAMPLE)),
    "lr_certificate": f"SELECT CAST(position AS BIGINT) AS position, CAST(0 AS DOUBLE) AS violation FROM range(-1, {len(BINARY_V1) + len(CONTINUOUS_V1)}) g(position)",
    "dt_certificate": sql_features(f"SELECT {_LABELS}, CAST(0 AS BIGINT) AS bad_leaves FROM split WHERE split = 'train' GROUP BY churn", split_cte(TRAIN_TEST)),
    "rf_certificate": sql_features(f"SELECT {_LABELS}, CAST(0 AS DOUBLE) AS worst FROM split WHERE split = 'train' GROUP BY churn", split_cte(TRAIN_TEST)),
    "gbt_certificate": sql_features(
        f"""SELECT CAST(tree AS INTEGER) AS tree, count(*) AS n, CAST(0 AS DOUBLE) AS worst
        FROM split, range({SPOT_CHECK["gbt"]["maxIter"][0]}) g(tree) WHERE split = 'train' GROUP BY tree""",
        split_cte(TRAIN_TEST),
    ),
    "tuned_lr_checked": _grid_sql(TUNE_V1_SAMPLE["lr"]),
    **{f"tuned_v1_{name}_checked": _grid_sql(axes) for name, axes in TUNE_V1_SAMPLE.items() if name != "lr"},
    **{f"tuned_{name}_checked": _grid_sql(axes) for name, axes in TUNE_V2_SAMPLE.items()},
    "stacked_grid_checked": _grid_sql(META_GRID),
    "tuned_lr_best_checked": _best_sql(TUNE_V1_SAMPLE["lr"]),
    **{f"tuned_v1_{name}_best_checked": _best_sql(axes) for name, axes in TUNE_V1_SAMPLE.items() if name != "lr"},
    **{f"tuned_{name}_best_checked": _best_sql(axes) for name, axes in TUNE_V2_SAMPLE.items()},
    "stacked_best_checked": _best_sql(META_GRID),
}
