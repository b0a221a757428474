import pytest
from pyspark.sql import functions as F

from churnloom.operators import profile as P
from churnloom.operators import relevance as R
from churnloom.operators import split as S
from churnloom.schema import NUMERIC_FEATURES


def _where(split):
    return {r.userId: r.split for r in split.select("userId", "split").collect()}


@pytest.mark.parametrize("make", [S.random_split, S.stratified_split])
def test_split_does_not_depend_on_partitioning(stored, make):
    a = _where(make(stored))
    b = _where(make(stored.orderBy(F.desc("nr_songs")).repartition(5)))
    assert a == b and len(a) == 150


@pytest.mark.parametrize("shares", [S.TRAIN_TEST, S.THREE_WAY_SAMPLE, S.THREE_WAY_FULL])
def test_stratified_ratio_is_exact_per_class(stored, shares):
    sizes = {(r.split, r.churn): r.n for r in S.split_sizes(S.stratified_split(stored, shares)).collect()}
    for churn in (0, 1):
        whole = sum(n for (_, c), n in sizes.items() if c == churn)
        for name, share in shares.items():
            assert abs(sizes[name, churn] - share * whole) <= 1


def test_parts_are_disjoint_and_complete(stored):
    made = S.parts(S.stratified_split(stored), ["train", "test"])
    train, test = ({r.userId for r in df.collect()} for df in made.values())
    assert not train & test and len(train | test) == 150
    assert S.stack(*made.values()).count() == 150


def test_another_seed_gives_another_split(stored):
    assert _where(S.stratified_split(stored, seed=1)) != _where(S.stratified_split(stored, seed=2))


def test_constant_feature_has_no_median_difference(stored):
    flat = stored.withColumn("flat", F.lit(0))
    assert R.median_difference(flat, ["flat"]).first().normal_diff is None


def test_median_difference_sign(stored):
    a = {r.column: r.normal_diff for r in R.median_difference(stored, NUMERIC_FEATURES).collect()}
    b = {r.column: r.normal_diff for r in R.median_difference(stored, NUMERIC_FEATURES, zero_minus_one=True).collect()}
    assert all(a[k] == pytest.approx(-b[k]) for k in a if a[k] is not None)


def test_medians_equal_the_builtin(stored):
    want = {r.churn: r.m for r in stored.groupBy("churn").agg(F.median("avg_sess_h").alias("m")).collect()}
    got = {r.churn: r.median for r in R.class_medians(stored, ["avg_sess_h"]).collect()}
    assert got == pytest.approx(want)


def test_approximate_distinct_counts_are_close(stored):
    exact = {r.column: r.n_distinct for r in P.distinct_counts(stored).collect()}
    close = {r.column: r.n_distinct for r in P.distinct_counts(stored, approximate=True).collect()}
    assert all(abs(close[c] - n) <= max(2, 0.2 * n) for c, n in exact.items())


def test_share_counts_missing_in_the_total(make_log):
    log = make_log({"gender": "F"}, {"gender": "F"}, {"gender": None}, {"gender": "M"})
    assert {r.gender: (r.n, r.percentage) for r in P.share_by(log, "gender").collect()} == {"F": (2, 50.0), "M": (1, 25.0)}


def test_missing_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    assert {r.column: r.n_missing for r in P.missing_counts(df).collect()} == {"x": 2, "s": 1}


def test_shared_sessions(make_log):
    log = make_log({"userId": "1"}, {"userId": "2"}, {"userId": "2"}, {"userId": "3", "sessionId": 8})
    assert [tuple(r) for r in P.shared_sessions(log).collect()] == [(1, 2, 3)]
    assert [tuple(r) for r in P.repeated_sessions(log).collect()] == [("2", 1, 2)]
