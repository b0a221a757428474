import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from churnloom.ml import boosting
from churnloom.ml import metrics as M
from churnloom.ml.stacking import base_scores, fit_base, stack_and_score
from churnloom.ml.stages import TUNE_V1_FULL, TUNE_V1_SAMPLE, TUNE_V2_FULL, classifier, full_estimator, param_maps, preparation
from churnloom.ml.trees import prefix, shallower
from churnloom.ml.tune import fit_prepared, grid_search, prepared_folds, scored, spot_check, tune, with_folds
from churnloom.operators.split import THREE_WAY_SAMPLE, parts, stratified_split


@pytest.fixture(scope="module")
def train_test(stored):
    return parts(stratified_split(stored), ["train", "test"])


def _predictions(spark, rows):
    return spark.createDataFrame([(float(y), float(p), float(s)) for y, p, s in rows], "label double, prediction double, score double")


def test_metrics_without_positive_predictions_are_null(spark):
    r = M.confusion_metrics(_predictions(spark, [(0, 0, 0.1), (1, 0, 0.2)])).first()
    assert (r.accuracy, r.precision, r.recall, r.f1_score) == (0.5, None, 0.0, None)


def test_confusion_metrics(spark):
    r = M.confusion_metrics(_predictions(spark, [(0, 0, 0), (0, 1, 1), (1, 1, 1), (1, 1, 1), (1, 0, 0)])).first()
    assert (r.tn, r.tp, r.fn, r.fp) == (1, 2, 1, 1)
    assert r.precision == pytest.approx(2 / 3) and r.recall == pytest.approx(2 / 3) and r.f1_score == pytest.approx(2 / 3)


def test_curve_areas_equal_the_evaluator(spark):
    rng = np.random.default_rng(2)
    rows = [(y := int(rng.random() < 0.3), 0, round(float(rng.random() * 0.7 + 0.3 * y), 2)) for _ in range(400)]
    df = _predictions(spark, rows)
    a = M.curve_areas(df).first()
    assert a.auc_roc == pytest.approx(M.evaluator_area(df, "areaUnderROC", score="score"), abs=1e-12)
    assert a.no_skill_pr == pytest.approx(sum(y for y, _, _ in rows) / 400)
    points = [(r.fpr, r.tpr) for r in M.roc_points(df).orderBy("fpr", "tpr").collect()]
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    assert np.trapezoid([y for _, y in points], [x for x, _ in points]) == pytest.approx(a.auc_roc, abs=1e-12)
    pr = [(r.recall, r.precision) for r in M.pr_points(df).collect()]
    assert (0.0, 1.0) in pr


def test_tied_scores_make_one_point(spark):
    df = _predictions(spark, [(0, 0, 0.5), (1, 1, 0.5), (1, 1, 0.9)])
    assert M.curve_points(df).count() == 2


def test_report_has_a_column_per_model(spark):
    df = _predictions(spark, [(0, 0, 0.1), (1, 1, 0.9), (1, 0, 0.4)])
    both = M.stack_models({"a": df, "b": df.withColumn("prediction", F.lit(1.0))})
    wide = M.metrics_by_model(M.metric_report(both), ["a", "b"])
    assert wide.columns == ["metric", "a", "b"] and wide.count() == 6


def test_label_stays_put_when_churners_are_the_majority(stored):
    many = stored.withColumn("churn", 1 - F.col("churn"))
    out = preparation().fit(many).transform(many)
    assert out.where(F.col("label") != F.col("churn")).count() == 0


def test_constant_column_scales_to_zero(stored):
    flat = stored.withColumn("nr_error", F.lit(3))
    out = preparation().fit(flat).transform(flat)
    k = 1 + 6  # level first, then the seventh continuous input
    assert {r[0] for r in out.select(vector_to_array("features")[k]).distinct().collect()} == {0.0}


def test_feature_vector_widths(stored):
    v2 = preparation("v2").fit(stored).transform(stored).first().features
    with_downgrade = stored.withColumn("downgrade", F.lit(0))
    v1 = preparation("v1").fit(with_downgrade).transform(with_downgrade).first().features
    assert (len(v2), len(v1)) == (18, 23)


def test_every_grid_point_is_listed():
    sizes = {n: len(param_maps(classifier(n), TUNE_V2_FULL[n])) for n in TUNE_V2_FULL}
    assert sizes == {"gbt": 4, "mlpc": 18}
    assert len(param_maps(classifier("mlpc"), TUNE_V1_SAMPLE["mlpc"])) == 12
    assert len(param_maps(classifier("mlpc"), TUNE_V1_FULL["mlpc"])) == 4


def test_step_sizes_a_solver_ignores_score_alike(train_test):
    found = grid_search(preparation(), classifier("mlpc"), {"stepSize": [0.01, 0.5], "maxIter": [3]}, train_test["train"], folds=2)
    assert len(found.scores) == 2 and found.scores[0] == found.scores[1]


def test_kept_tables_go_when_a_fit_fails(spark, train_test):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(Exception):
        grid_search(preparation(), classifier("lr").setFeaturesCol("nowhere"), {"regParam": [0.1]}, train_test["train"], folds=2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_folds_are_even_per_class(stored):
    counts = with_folds(stored).groupBy("churn", "fold").count().collect()
    for churn in (0, 1):
        sizes = [r["count"] for r in counts if r.churn == churn]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_full_estimator_trains(train_test):
    model = full_estimator("dt").fit(train_test["train"])
    assert scored(model.transform(train_test["test"]), "dt").count() == 45


def test_tuning_returns_scores_and_best(train_test):
    found, predictions = tune("lr", {"regParam": [0.1, 1.0], "maxIter": [5, 50]}, **train_test, folds=3)
    assert len(found.scores) == 4 and max(found.scores) <= 1.0
    assert set(found.best_params) == {"regParam", "maxIter"}
    assert found.table(predictions).count() == 8
    assert predictions.count() == 45


def test_shared_fits_score_as_separate_ones(train_test):
    axes = {"regParam": [0.5], "maxIter": [40, 100]}
    together = grid_search(preparation(), classifier("lr"), axes, train_test["train"], folds=3).scores
    apart = [
        grid_search(preparation(), classifier("lr"), {"regParam": [0.5], "maxIter": [m]}, train_test["train"], folds=3).scores[0]
        for m in (40, 100)
    ]
    assert together == pytest.approx(apart)


def _separate_scores(train, estimator, axes, folds):
    """Mean area of every point, each fold prepared and fitted apart."""
    dealt = with_folds(train, folds).coalesce(1).persist()
    out = []
    for m in param_maps(estimator, axes):
        areas = []
        for k in range(folds):
            inner = dealt.where(F.col("fold") != k)
            stages = preparation().fit(inner)
            model = estimator.fit(stages.transform(inner), m)
            areas.append(M.evaluator_area(model.transform(stages.transform(dealt.where(F.col("fold") == k))), "areaUnderROC"))
        out.append(sum(areas) / folds)
    dealt.unpersist()
    return out


@pytest.mark.parametrize(
    ("name", "axes"),
    [
        ("lr", {"regParam": [0.1, 0.5], "maxIter": [3, 40]}),
        ("dt", {"maxDepth": [2, 5, 15]}),
        ("gbt", {"maxDepth": [2, 12, 15], "maxIter": [2, 4], "stepSize": [0.1]}),
    ],
)
def test_searches_score_as_separate_fits(train_test, name, axes):
    estimator = classifier(name)
    found = grid_search(preparation(), estimator, axes, train_test["train"], folds=2)
    assert found.scores == pytest.approx(_separate_scores(train_test["train"], estimator, axes, 2), abs=1e-12)


def test_one_table_is_kept_for_all_folds(spark, train_test):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with prepared_folds(preparation(), train_test["train"], 5) as data:
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == before + 1
        for k in range(5):
            fit_on, check_on = data.pair(k)
            want = preparation().fit(fit_on.select(train_test["train"].columns))
            got = {r[0]: r[1].toArray() for r in check_on.select("userId", "features").collect()}
            for r in want.transform(check_on.select(train_test["train"].columns)).select("userId", "features").collect():
                assert np.abs(got[r[0]] - r[1].toArray()).max() < 1e-12
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_prefix_of_an_ensemble_is_its_own_fit(train_test):
    rows = preparation().fit(train_test["train"]).transform(train_test["train"]).coalesce(1).persist()
    long = classifier("gbt").setMaxIter(7).fit(rows)
    for steps in (1, 4, 7):
        own, part = classifier("gbt").setMaxIter(steps).fit(rows), prefix(long, steps)
        a, b = ([tuple(r) for r in m.transform(rows).select("userId", "rawPrediction", "probability", "prediction").orderBy("userId").collect()] for m in (own, part))
        assert a == b
    rows.unpersist()


def test_chosen_point_is_the_best_one(train_test):
    found, predictions = tune("dt", {"maxDepth": [1, 3], "maxBins": [8, 16]}, **train_test, folds=2)
    best = {r.parameter: r for r in found.chosen(predictions).collect()}
    assert {n: r.value for n, r in best.items()} == {n: float(v) for n, v in found.best_params.items()}
    assert all(r.higher == 0 and r.score == max(found.scores) for r in best.values())
    assert found.fitted_params() == found.best_params


def test_spot_check_scores_both_splits(train_test):
    _, table = spot_check(**train_test, names=["dt", "rf"], folds=2)
    sizes = {(r.model, r.split): r["count"] for r in table.groupBy("model", "split").count().collect()}
    assert sizes == {("dt", "train"): 105, ("dt", "test"): 45, ("rf", "train"): 105, ("rf", "test"): 45}


def test_stacking(stored):
    made = parts(stratified_split(stored, THREE_WAY_SAMPLE), list(THREE_WAY_SAMPLE))
    base, found, out = stack_and_score(**made, axes={"regParam": [0.1]}, folds=2)
    assert out.count() == made["test"].count()
    area = M.curve_areas(out, label="meta_label").first().auc_roc
    assert 0.0 <= area <= 1.0
    models = {r.model for r in base_scores(base, made["validation"]).select("model").distinct().collect()}
    assert models == {"lr", "rf", "gbt", "mlpc", "lsvc"}


def test_few_partitions_are_put_together_from_computed_rows(train_test):
    many = train_test["train"].repartition(7, "nr_likes")
    with prepared_folds(preparation(), many, 3, partitions=2) as data:
        plan = data.kept._jdf.queryExecution().optimizedPlan().toString()
        cached = data.kept._jdf.queryExecution().withCachedData().toString()
        assert data.kept.rdd.getNumPartitions() == 2 and "InMemoryRelation" in cached
        # the tasks of the kept table read rows, they neither sort nor join nor window
        assert "Scan ExistingRDD" in plan and not any(step in plan for step in ("Window", "Sort", "Join", "Exchange"))
        assert data.kept.count() == 105


def test_fits_carry_no_plan_along(spark, train_test, monkeypatch):
    seen, fit = [], DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, rows: seen.append(rows) or fit(self, rows))
    grid_search(preparation(), classifier("dt"), {"maxDepth": [2]}, train_test["train"], folds=2)
    fit_prepared(preparation(), {"dt": classifier("dt")}, train_test["train"])
    assert len(seen) == 4
    for rows in seen:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" in plan and "UDF" not in plan and "Filter" not in plan and "parquet" not in plan.lower()
    # what was checkpointed for them is gone
    with pytest.raises(Exception):
        seen[0].select("features").collect()


def test_converged_perceptrons_serve_higher_limits(train_test, monkeypatch):
    limits, fit = [], MultilayerPerceptronClassifier._fit
    monkeypatch.setattr(MultilayerPerceptronClassifier, "_fit", lambda self, rows: limits.append(self.getMaxIter()) or fit(self, rows))
    easy = classifier("mlpc").setTol(0.5)
    found = grid_search(preparation(), easy, {"maxIter": [40, 80, 160]}, train_test["train"], folds=2)
    assert sorted(limits[:-1]) == [40, 40] and len(set(found.scores)) == 1
    apart = grid_search(preparation(), easy, {"maxIter": [160]}, train_test["train"], folds=2)
    assert apart.scores[0] == found.scores[2]


def test_cut_forest_is_its_own_fit(spark):
    """Labels that nothing tells apart, repeated rows, and three partitions: deep trees, impure leaves, merged siblings."""
    rng = np.random.default_rng(4)
    made = [(float(rng.random() < 0.4), [float(x) for x in rng.integers(0, 9, 5)]) for _ in range(500)]
    rows = spark.createDataFrame([*made, *made[:60]], "label double, f array<double>").select("label", array_to_vector("f").alias("features")).coalesce(3).persist()
    forest = RandomForestClassifier(seed=5, numTrees=7)
    deep = forest.copy({forest.maxDepth: 20}).fit(rows)
    cut = shallower(deep, [1, 4, 9, 19])
    assert sorted(cut) == [1, 4, 9, 19]
    body = lambda m: m.toDebugString.split("\n", 1)[1]
    for limit, model in cut.items():
        own = forest.copy({forest.maxDepth: limit}).fit(rows)
        assert body(model) == body(own) and (model is deep) == (body(own) == body(deep))
        a, b = ([tuple(r) for r in m.transform(rows).select("label", "features", "rawPrediction", "probability", "prediction").collect()] for m in (model, own))
        assert a == b
    # levels that the trainer may have taken in several groups draw in another order
    small = forest.copy({forest.maxDepth: 20, forest.maxMemoryInMB: 0}).fit(rows)
    assert shallower(small, [4, 9]) == {}
    rows.unpersist()


def test_forests_are_fitted_once_for_all_depths(train_test, monkeypatch):
    depths, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, rows: depths.append(self.getMaxDepth()) or fit(self, rows))
    axes = {"maxDepth": [1, 3, 9], "numTrees": [3, 5]}
    found = grid_search(preparation(), classifier("rf"), axes, train_test["train"], folds=2, partitions=1)
    assert depths[:-1] == [9] * 4 and found.fitted_params() == found.best_params
    for depth in axes["maxDepth"]:
        apart = grid_search(preparation(), classifier("rf"), axes | {"maxDepth": [depth]}, train_test["train"], folds=2, partitions=1)
        assert apart.scores == [x for m, x in zip(found.maps, found.scores) if depth in m.values() and {p.name: v for p, v in m.items()}["maxDepth"] == depth]


def test_mixtures_of_no_penalty_share_a_fit(train_test, monkeypatch):
    points, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, rows: points.append((self.getRegParam(), self.getElasticNetParam())) or fit(self, rows))
    axes = {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5], "maxIter": [3]}
    found = grid_search(preparation(), classifier("lr"), axes, train_test["train"], folds=2, partitions=1)
    assert sorted(points[:-1]) == sorted(2 * [(0.0, 0.5), (0.1, 0.0), (0.1, 0.5)]) and found.fitted_params() == found.best_params
    for mixture in (0.0, 0.5):
        apart = grid_search(preparation(), classifier("lr"), axes | {"elasticNetParam": [mixture]}, train_test["train"], folds=2, partitions=1)
        own = [x for m, x in zip(found.maps, found.scores) if {p.name: v for p, v in m.items()}["elasticNetParam"] == mixture]
        assert apart.scores == own


def test_boosters_are_grown_side_by_side(spark, train_test, monkeypatch):
    """Only the chosen point is a fit of its own."""
    depths, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, rows: depths.append(self.getMaxDepth()) or fit(self, rows))
    axes = {"maxDepth": [2, 9], "maxBins": [8, 16], "maxIter": [2, 3], "stepSize": [0.1, 0.5]}
    found = grid_search(preparation(), classifier("gbt"), axes, train_test["train"], folds=2)
    assert len(depths) == 1 and len(found.scores) == 16 and found.fitted_params() == found.best_params
    monkeypatch.setattr(boosting, "plain", lambda estimator: False)
    assert grid_search(preparation(), classifier("gbt"), axes, train_test["train"], folds=2).scores == found.scores


@pytest.mark.parametrize(("n", "most", "digits"), [(400, 20_000, 15), (400, 60, 9), (12_000, 2_500, 9)])
def test_boosters_side_by_side_are_their_own_fits(spark, monkeypatch, n, most, digits):
    """With nodes above the size that one task takes, a constant input, zeros, and more rows than thresholds are drawn from."""
    monkeypatch.setattr(boosting, "ROWS_PER_NODE", most)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=(n, 2)), rng.exponential(size=n) * (rng.random(n) < 0.6), np.full(n, 2.0)])
    y = (x[:, 0] + x[:, 2] + rng.normal(size=n) > 0.3).astype(float)
    made = spark.createDataFrame([(float(b), a.tolist()) for a, b in zip(x, y)], "label double, f array<double>")
    rows = made.select("label", array_to_vector("f").alias("features")).coalesce(1).persist()
    learner = classifier("gbt")
    fits = [boosting.Fit(0, depth, bins, 0.3) for depth, bins in ((1, 32), (6, 16))]
    for steps, table in boosting.margins(learner, fits, [(rows, rows)], "label", [1, 2]):
        for k, f in enumerate(fits):
            own = learner.copy().setMaxDepth(f.depth).setMaxBins(f.bins).setStepSize(f.step).setMaxIter(steps).fit(rows)
            want = sorted((r.label, round(float(r.rawPrediction[1]), digits)) for r in own.transform(rows).collect())
            got = sorted((r.label, round(r.margin, digits)) for r in table.where(F.col("fit") == k).collect())
            assert np.allclose(got, want, rtol=0, atol=10.0**-digits if most < n else 1e-14)
    rows.unpersist()


def test_roots_of_some_ten_thousand_rows_are_grown_by_one_task(spark, monkeypatch):
    """21,000 rows of a fit need no jobs level by level; with them the margins are the same."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(21_000, 2))
    y = (x[:, 0] + rng.normal(size=len(x)) > 0.3).astype(float)
    made = spark.createDataFrame([(float(b), a.tolist()) for a, b in zip(x, y)], "label double, f array<double>")
    rows = made.select("label", array_to_vector("f").alias("features")).coalesce(1).persist()
    asked, split = [], boosting._large_splits
    monkeypatch.setattr(boosting, "_large_splits", lambda *a: asked.append(1) or split(*a))
    found = []
    for most in (boosting.ROWS_PER_NODE, 20_000):
        monkeypatch.setattr(boosting, "ROWS_PER_NODE", most)
        for _, table in boosting.margins(classifier("gbt"), [boosting.Fit(0, 3, 8, 0.3)], [(rows, rows.limit(500))], "label", [1]):
            found.append(sorted(r.margin for r in table.collect()))
        assert bool(asked) == (most == 20_000)
    rows.unpersist()
    assert np.allclose(*found, rtol=0, atol=1e-9)


def test_rows_of_a_forest_note_their_node(spark, train_test, monkeypatch):
    """In the search and in the refit; the trees are those of a fit that does not."""
    noted, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, rows: noted.append(self.getCacheNodeIds()) or fit(self, rows))
    axes = {"maxDepth": [3], "numTrees": [4]}
    found = grid_search(preparation(), classifier("rf"), axes, train_test["train"], folds=2)
    assert noted == [True] * 3
    model = found.best.stages[-1]
    with monkeypatch.context() as plain:
        plain.setattr(RandomForestClassifier, "setCacheNodeIds", lambda self, value: self)
        own = fit_prepared(preparation(), {"rf": classifier("rf").setMaxDepth(3).setNumTrees(4)}, train_test["train"]).stages[-1]
    assert noted[-1] is False and own.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]
