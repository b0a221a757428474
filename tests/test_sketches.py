"""Sketches per day and keyed samples against exact figures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnloom.operators import profile as P
from churnloom.operators import sketches as K

DAY = 86_400_000


@pytest.fixture(scope="module")
def days(spark):
    """Thirty days from 1970-01-02 on; day d holds users 200 d to 200 d + 999, and lengths that grow with the day."""
    rng = np.random.default_rng(4)
    rows = [(f"u{200 * d + k}", float(d + rng.random()), d * DAY + k) for d in range(1, 31) for k in range(1000)]
    rows += [(None, None, DAY), ("u200", float("nan"), DAY + 1)]
    return spark.createDataFrame(rows, "userId string, length double, ts long").repartition(7)


def test_distinct_values_of_any_range_of_days(days):
    sketches = K.daily_distinct(days, ["userId"]).cache()
    assert sketches.count() == 30
    for first, last in ((1, 30), (3, 3), (10, 19)):
        span = [f"1970-01-{1 + d:02d}" for d in (first, last)]
        (got,) = K.distinct_between(sketches, *span).collect()
        want = 1000 + 200 * (last - first)
        assert abs(got.n_distinct - want) <= want * K.DISTINCT_ERROR + 1
    assert K.distinct_between(sketches, "1980-01-01").collect() == []


def test_distinct_certificate_sees_a_wrong_estimate(days):
    exact = P.distinct_counts(days.select("userId"))
    about = K.distinct_between(K.daily_distinct(days, ["userId"]))
    assert [r.close for r in K.distinct_certificate(about, exact).collect()] == [True]
    wrong = about.withColumn("n_distinct", F.col("n_distinct") * 1.05)
    assert [r.close for r in K.distinct_certificate(wrong, exact).collect()] == [False]
    assert [r.close for r in K.distinct_certificate(about.limit(0), exact).collect()] == [False]


def test_quantiles_of_a_range_of_days(days):
    probs = [0.1, 0.5, 0.9]
    sketches = K.daily_quantiles(days, "length").cache()
    (got,) = K.quantiles_between(sketches, probs, first="1970-01-06", last="1970-01-15").collect()
    lengths = days.where(f"ts >= {5 * DAY} AND ts < {15 * DAY}").toPandas()["length"]
    assert got.n == len(lengths) == 10_000
    assert [float((lengths <= q).mean()) for q in got.quantiles] == pytest.approx(probs, abs=K.RANK_ERROR)


def test_rank_certificate_sees_a_wrong_quantile(days):
    probs = [0.25, 0.75]
    rows = days.select("length", F.lit(1).alias("g"))
    good = K.quantiles_between(K.daily_quantiles(rows.withColumn("ts", F.lit(0).cast("long")), "length", ["g"]), probs, ["g"])
    assert [(r.n, r.close) for r in K.rank_certificate(rows, "length", ["g"], good, probs).collect()] == [(30_000, True)] * 2
    bad = good.withColumn("quantiles", F.transform("quantiles", lambda q: q + 1.5))
    assert [r.close for r in K.rank_certificate(rows, "length", ["g"], bad, probs).collect()] == [False, False]


def test_rank_certificate_with_ties(spark):
    rows = spark.createDataFrame([(1, 0.0)] * 900 + [(1, 5.0)] * 100, "g int, v double")
    at = lambda q: spark.createDataFrame([(1, [q])], "g int, quantiles array<double>")
    close = lambda q, p: K.rank_certificate(rows, "v", ["g"], at(q), [p]).first().close
    assert close(0.0, 0.5) and close(0.0, 0.01) and close(5.0, 0.95)
    assert not close(5.0, 0.5) and not close(0.0, 0.95)


def test_sample_does_not_depend_on_partitions_and_merges(days):
    rows = lambda df: sorted(map(str, df.collect()))
    whole = P.keyed_sample(days, 50)
    assert len(rows(whole)) == 50
    assert rows(P.keyed_sample(days.repartition(3, "ts"), 50)) == rows(whole)
    parts = [P.keyed_sample(days.where(f"ts % 2 = {k}"), 50) for k in (0, 1)]
    assert rows(P.keyed_sample(parts[0].unionByName(parts[1]), 50)) == rows(whole)
    assert rows(P.keyed_sample(days, 50, seed=2)) != rows(whole)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_sample_of_little(days):
    assert P.keyed_sample(days.limit(0), 5).collect() == []
    repeated = days.limit(1).unionByName(days.limit(1))
    assert P.keyed_sample(repeated, 5).count() == 2
