"""Ordered plans, rank correlation and lookups against brute force."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnloom.plans.kendall import _met, kendall_matrix, kendall_pairs, ranks_with, strong_pairs, weak_features
from churnloom.plans.ordered import _brackets, dense_ranks, even_buckets, exact_quantiles, running_totals

PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SLOW
@given(st.lists(st.floats(-1e12, 1e12, allow_nan=False), min_size=1, max_size=40))
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(0, float(v)) for v in values], "k int, v double")
    got = {r.prob: r.quantile for r in exact_quantiles(df, ["k"], "v", PROBS).collect()}
    want = np.quantile(np.array(values, float), PROBS)
    assert [got[p] for p in PROBS] == pytest.approx(list(want), rel=1e-9, abs=1e-9)


def test_quantiles_with_a_value_that_fills_the_group(spark):
    # two thirds of the rows are one value; it is counted once, not gathered
    values = [0.0] * 2000 + [float(k) / 7 for k in range(1, 1001)]
    df = spark.createDataFrame([(0, v) for v in values], "k int, v double")
    got = {r.prob: r.quantile for r in exact_quantiles(df, ["k"], "v", PROBS).collect()}
    assert [got[p] for p in PROBS] == pytest.approx(list(np.quantile(values, PROBS)))


def test_quantiles_skip_missing(spark):
    df = spark.createDataFrame([(0, None), (0, float("nan")), (0, 1.0), (0, 3.0)], "k int, v double")
    assert exact_quantiles(df, ["k"], "v", [0.5]).first().quantile == 2.0


def test_buckets_are_monotone(spark):
    rng = np.random.default_rng(3)
    v = np.sort(np.concatenate([rng.normal(0, 10.0**e, 200) for e in range(-14, 15)] + [[0.0, 1e300, -1e300]]))
    rows = spark.createDataFrame([(0, float(x)) for x in v], "k int, v double")
    for cuts in (_brackets(PROBS), [0.5], [0.2, 0.4, 0.6, 0.8]):
        buckets = [r._bucket for r in even_buckets(rows, ["k"], "v", cuts).orderBy("v").collect()]
        assert buckets == sorted(buckets) and set(buckets) <= set(range(len(cuts) + 1))


def test_quantiles_of_values_that_are_close_together(spark):
    """A million values within 1e-4: exact, and the buckets that hold a wanted position hold under 1 % of them."""
    df = spark.range(1_000_000).select(F.lit(0).alias("k"), (1000 + F.rand(5) * 1e-4).alias("v"))
    got = {r.prob: r.quantile for r in exact_quantiles(df, ["k"], "v", PROBS).collect()}
    v = df.toPandas()["v"].to_numpy()
    assert [got[p] for p in PROBS] == pytest.approx(list(np.quantile(v, PROBS)), abs=1e-12)
    sizes = np.bincount([r._bucket for r in even_buckets(df, ["k"], "v", _brackets(PROBS)).select("_bucket").collect()])
    ends = np.cumsum(sizes)
    sorted_rows = {int(np.searchsorted(ends, p * (len(v) - 1), side="right")) for p in PROBS}
    assert max(sizes[b] for b in sorted_rows) < 0.01 * len(v)


def test_quantiles_at_both_ends_of_the_doubles(spark):
    values = [-1.7e308, -1e291, -5e-324, 0.0, 5e-324, 1e291, 1.1e291, 1.7e308]
    df = spark.createDataFrame([(0, v) for v in values], "k int, v double")
    got = {r.prob: r.quantile for r in exact_quantiles(df, ["k"], "v", [k / 7 for k in range(8)]).collect()}
    assert [got[k / 7] for k in range(8)] == values


def test_running_totals_both_ways(spark):
    rng = np.random.default_rng(5)
    values = sorted({float(x) for x in rng.random(500)})
    weights = rng.integers(0, 9, len(values))
    df = spark.createDataFrame([("a", v, int(w)) for v, w in zip(values, weights)], "g string, v double, w long")
    up = {r.v: (r.run_w, r.all_w) for r in running_totals(df, ["g"], "v", ["w"]).collect()}
    down = {r.v: r.run_w for r in running_totals(df, ["g"], "v", ["w"], descending=True).collect()}
    total, seen = int(weights.sum()), np.cumsum(weights)
    for v, w, s in zip(values, weights, seen):
        assert up[v] == (s, total)
        assert down[v] == total - s + w


def test_dense_ranks(spark):
    df = spark.createDataFrame([("a", 2.5), ("a", -1.0), ("a", 2.5), ("b", 9.0)], "g string, v double")
    got = {(r.g, r.v): r.rank for r in dense_ranks(df, ["g"], "v").collect()}
    assert got == {("a", -1.0): 0, ("a", 2.5): 1, ("b", 9.0): 0}


def _tau(x, y):
    sx, sy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    den = np.sqrt((sx**2).sum()) * np.sqrt((sy**2).sum())
    return (sx * sy).sum() / den if den else None


@pytest.fixture(scope="module")
def study(spark):
    rng = np.random.default_rng(1)
    n = 300
    x = rng.integers(0, 40, n)
    cols = {
        "x": x,
        "wide": rng.integers(-5000, 5000, n),
        "frac": np.round(rng.normal(size=n), 1) + x / 7,
        "flag": (x > 20).astype(int),
        "same": np.full(n, 4),
    }
    rows = [(str(k), *[v[k].item() for v in cols.values()]) for k in range(n)]
    df = spark.createDataFrame(rows, "id string, x long, wide long, frac double, flag int, same long")
    return df, cols


def test_kendall_equals_all_pairs(study):
    df, cols = study
    pairs = kendall_pairs(df, list(cols), "id").collect()
    assert len(pairs) == 10
    for r in pairs:
        want = _tau(cols[r.feature_a].astype(float), cols[r.feature_b].astype(float))
        assert r.tau is None if want is None else r.tau == pytest.approx(want, abs=1e-12)


def test_kendall_of_long_columns(spark):
    """Several digits on both sides, many buckets, heavy ties, and codes of 63 bits, against pairs counted one by one."""
    rng = np.random.default_rng(2)
    n = 1500
    a = rng.permutation(n) * 1.5
    b = np.where(rng.random(n) < 0.7, 0, rng.integers(0, 10**6, n))
    c = np.where(rng.random(n) < 0.5, a, rng.normal(size=n) * 1000)
    d = np.array([0, 2**62] * (n // 2)) + rng.integers(0, 2**61, n)
    rows = [(str(k), float(a[k]), int(b[k]), float(c[k]), int(d[k])) for k in range(n)]
    df = spark.createDataFrame(rows, "id string, a double, b long, c double, d long")
    ranks = {k: np.unique(v, return_inverse=True)[1].astype(float) for k, v in {"a": a, "b": b, "c": c, "d": d}.items()}
    got = {(r.feature_a, r.feature_b): r.tau for r in kendall_pairs(df, list("abcd"), "id").collect()}
    assert got == {k: pytest.approx(_tau(ranks[k[0]], ranks[k[1]]), abs=1e-12) for k in got} and len(got) == 6


def test_large_counts_agree_with_small_ones(spark):
    """The walk over counts beyond 2^31 goes through decimals, and gives the multiple."""
    digits = [f"CAST(k * {7 * m + 3} % 11 * size AS BIGINT) AS s{m}" for m in range(16)]
    sums = {}
    for size in (1, 2**33):
        df = spark.range(40).selectExpr("id % 4 AS g", "id AS k", f"{size}L AS size").selectExpr("g", "k", *digits)
        sums[size] = _met(df, ["g"], "k").agg(F.sum("agree"), F.sum("disagree")).first()
    assert [int(v) * 2**66 for v in sums[1]] == [int(v) for v in sums[2**33]] and min(sums[1]) > 0


def test_kendall_matrix_and_filters(study):
    df, cols = study
    m = {(r.feature_a, r.feature_b): r.tau for r in kendall_matrix(df, ["x", "frac", "flag"], "id").collect()}
    assert len(m) == 9 and m["x", "x"] == 1.0 and m["x", "flag"] == m["flag", "x"]
    pairs = kendall_pairs(df, ["x", "wide", "flag"], "id")
    assert {(r.feature_a, r.feature_b) for r in strong_pairs(pairs, 0.6).collect()} == {("x", "flag")}
    ranks = ranks_with(pairs, "flag")
    assert [r.feature for r in ranks.collect()] == ["x", "wide"]
    assert [r.feature for r in weak_features(ranks, 0.2).collect()] == ["wide"]


def test_pairs_of_one_column_are_the_same_and_the_only_ones(study):
    df, _ = study
    every = {(r.feature_a, r.feature_b): r.tau for r in kendall_pairs(df, ["x", "wide", "frac", "flag"], "id").collect()}
    some = {(r.feature_a, r.feature_b): r.tau for r in kendall_pairs(df, ["x", "wide", "frac", "flag"], "id", "flag").collect()}
    assert some == {k: v for k, v in every.items() if "flag" in k} and len(some) == 3


def test_close_scores_are_spread_over_the_buckets(spark):
    df = spark.range(200_000).select(F.lit("a").alias("g"), (0.9975 + 0.0025 / (1 + F.exp(-10 * F.rand(3)))).alias("v")).distinct()
    sizes = [r["count"] for r in even_buckets(df, ["g"], "v").groupBy("_bucket").count().collect()]
    assert len(sizes) == 256 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_large_data_paths_give_the_same_features(spark):
    """With broadcasting off everything goes through shuffled joins."""
    from churnloom.queries.common import v2_features
    from churnloom.queries.log_queries import QUERIES
    from conftest import DATA

    sf = f"{DATA}/sf0.001"
    rows = lambda df: sorted(map(str, df.collect()))
    want = rows(v2_features(spark, sf)), rows(QUERIES["preprocess_v2"](spark, sf)), rows(QUERIES["clean_v1"](spark, sf))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rows(v2_features(spark, sf)), rows(QUERIES["preprocess_v2"](spark, sf)), rows(QUERIES["clean_v1"](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want
