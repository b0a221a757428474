"""Certificates are zero for fitted models and not for damaged ones."""

import pytest
from pyspark.sql import functions as F

from churnloom.ml import certificates as C
from churnloom.ml.stages import classifier, preparation
from churnloom.ml.trees import tree_nodes
from churnloom.ml.tune import scored


@pytest.fixture(scope="module")
def rows(stored):
    out = preparation().fit(stored).transform(stored).select("userId", "label", "features").coalesce(1).persist()
    yield out
    out.unpersist()


@pytest.mark.parametrize(("reg", "elastic"), [(0.05, 0.0), (0.02, 0.5), (0.05, 1.0), (2.0, 1.0)])
def test_slopes_of_a_logistic_regression_vanish(rows, reg, elastic):
    model = classifier("lr").setRegParam(reg).setElasticNetParam(elastic).setMaxIter(500).setTol(1e-10).fit(rows)
    given = model.coefficients.toArray().tolist()
    worst = lambda c, b: {r.position: r.violation for r in C.logistic_violations(rows, c, b, reg, elastic).collect()}
    found = worst(given, model.intercept)
    assert set(found) == {-1, *range(18)} and max(found.values()) < 1e-4
    if reg == 2.0:
        assert not any(given)
    damaged = [c + (0.5 if j == 3 else 0.0) for j, c in enumerate(given)]
    assert max(worst(damaged, model.intercept).values()) > 0.01
    assert worst(given, model.intercept + 0.5)[-1] > 0.01


def test_leaves_count_the_rows_that_reach_them(rows, stored):
    model = classifier("dt").fit(rows)
    nodes = tree_nodes(model)
    reached = C.reached_leaves(rows, nodes, 5)
    sizes = {float(r.churn): r["count"] for r in stored.groupBy("churn").count().collect()}
    found = {r.label: (r.n, r.bad_leaves) for r in C.leaf_recount(reached, nodes).collect()}
    assert found == {label: (n, 0) for label, n in sizes.items()}
    moved = nodes.withColumn("threshold", F.when(F.col("node") == 0, -1e9).otherwise(F.col("threshold")))
    assert sum(r.bad_leaves for r in C.leaf_recount(C.reached_leaves(rows, moved, 5), nodes).collect()) > 0


def test_forests_vote_and_boosters_average(rows):
    forest = classifier("rf").setNumTrees(5).fit(rows)
    scores = scored(forest.transform(rows), "rf")
    reached = C.reached_leaves(rows, tree_nodes(forest), 5, 5)
    assert max(r.worst for r in C.vote_errors(reached, scores).collect()) < 1e-12
    other = reached.where("tree > 0")
    assert max(r.worst for r in C.vote_errors(other, scores).collect()) > 1e-3

    booster = classifier("gbt").setMaxIter(4).fit(rows)
    reached = C.reached_leaves(rows, tree_nodes(booster), 5, 4)
    found = C.residual_errors(reached, booster.treeWeights).collect()
    assert [r.tree for r in sorted(found)] == [0, 1, 2, 3] and max(r.worst for r in found) < 1e-9
    assert {r.n for r in found} == {rows.count()}
    assert max(r.worst for r in C.residual_errors(reached, [1.0, 0.5, 0.1, 0.1]).collect()) > 1e-3


def test_meta_table_with_wrong_entries(spark):
    """One wrong prediction, one vector that does not sum to 1, one prediction of the less likely class."""
    from pyspark.ml.linalg import Vectors

    from churnloom.ml.stacking import META_PREDICTIONS, META_PROBABILITIES, meta_violations

    fair = Vectors.dense(0.3, 0.7)

    def row(**other):
        return {**dict.fromkeys(META_PREDICTIONS, 1.0), **dict.fromkeys([*META_PROBABILITIES, "prob_gbt"], fair), "label": 1.0, **other}

    rows = [row(), row(pred_lsvc=2.0), row(prob_rf=Vectors.dense(0.3, 0.8)), row(prob_gbt=Vectors.dense(0.6, 0.4))]
    got = meta_violations(spark.createDataFrame(rows)).first()
    assert (got.n, got.bad_predictions, got.bad_probabilities, got.contradictions) == (4, 1, 1, 1)
