"""How features relate to churn: class summaries, histograms, medians, binned scatter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnloom.plans.ordered import exact_quantiles, tall
from churnloom.schema import NUMERIC_FEATURES

FIVE_NUMBERS = (0.0, 0.25, 0.5, 0.75, 1.0)

# The feature sets of the distribution plots.
HISTOGRAM_SAMPLE = [
    "nr_songs", "nr_playlist", "nr_friends", "nr_home", "nr_error", "nr_settings", "nr_ads",
    "nr_sessions", "n_acts",
]
BOX_FEATURES = [
    "songs_per_session", "acts_per_session", "ads_per_session", "nr_likes", "nr_dislikes",
    "nr_upgrades", "nr_downgrades", "init_days_interv", "tenure_days_interv", "active_days",
    "nr_error",
]
SCATTER_PAIRS = [
    ("nr_songs", "nr_playlist"),
    ("nr_songs", "nr_likes"),
    ("nr_songs", "nr_home"),
    ("nr_playlist", "nr_home"),
    ("nr_playlist", "nr_likes"),
    ("nr_likes", "nr_home"),
    ("n_acts", "avg_sess_h"),
]


def long_features(features: DataFrame, columns: Sequence[str], ids: Sequence[str] = ("churn",)) -> DataFrame:
    """One row per (row, feature): ids, ``feature``, ``value`` as double."""
    return tall(features, ids, columns)


def churn_rate(features: DataFrame) -> DataFrame:
    return features.agg(F.round(F.avg("churn"), 4).alias("churn_rate"))


def class_shares(features: DataFrame, *by: str) -> DataFrame:
    """Users per (churn[, by]) and their percentage of all users."""
    counts = features.groupBy("churn", *by).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percentage", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100)


def crosstab(features: DataFrame, rows: str, columns: str, values: Sequence = (0, 1)) -> DataFrame:
    """Contingency table of two low-cardinality columns, keys as text, zero where a pair is absent."""
    return (
        features.groupBy(F.col(rows).cast("string").alias(f"{rows}_{columns}"))
        .pivot(columns, list(values))
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


def class_histograms(features: DataFrame, columns: Sequence[str], widths: dict[str, float] | float) -> DataFrame:
    """Users per (feature, churn, bin); ``bin`` is the lower edge of a bin of fixed width."""
    width = F.lit(float(widths)) if not isinstance(widths, dict) else _per_feature(widths)
    binned = long_features(features, columns).withColumn("bin", F.floor(F.col("value") / width) * width)
    return binned.groupBy("feature", "churn", "bin").agg(F.count(F.lit(1)).alias("n"))


def five_numbers(features: DataFrame, columns: Sequence[str] = BOX_FEATURES, by: str = "churn") -> DataFrame:
    """Min, quartiles and max per feature and class, exact, one row per (feature, class)."""
    names = ("minimum", "q1", "median", "q3", "maximum")
    q = exact_quantiles(long_features(features, columns, (by,)), ["feature", by], "value", FIVE_NUMBERS)
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    return q.groupBy("feature", by).agg(*[at(p).alias(n) for p, n in zip(FIVE_NUMBERS, names)])


def class_medians(features: DataFrame, columns: Sequence[str], by: str = "churn", approximate: bool = False) -> DataFrame:
    """Median per feature and class: exact, or by a fixed-size sketch."""
    values = long_features(features, columns, (by,))
    if approximate:
        return values.groupBy("feature", by).agg(F.percentile_approx("value", 0.5, 10000).alias("median"))
    return exact_quantiles(values, ["feature", by], "value", [0.5]).select("feature", by, F.col("quantile").alias("median"))


def median_difference(
    features: DataFrame,
    columns: Sequence[str] = NUMERIC_FEATURES,
    by: str = "churn",
    zero_minus_one: bool = False,
    approximate: bool = False,
) -> DataFrame:
    """Normalised difference of the class medians per feature; null where both medians are 0.

    ``zero_minus_one`` turns the sign round (the first-generation form).
    """
    medians = class_medians(features, columns, by, approximate)
    of = lambda k: F.abs(F.max(F.when(F.col(by) == k, F.col("median"))))
    both = medians.groupBy("feature").agg(of(0).alias("m0"), of(1).alias("m1"))
    gap = F.col("m0") - F.col("m1") if zero_minus_one else F.col("m1") - F.col("m0")
    return both.select(
        F.concat(F.lit("nd_"), "feature").alias("column"),
        F.try_divide(gap, F.greatest("m0", "m1")).alias("normal_diff"),
    )


def ranked(differences: DataFrame) -> DataFrame:
    """Largest difference first."""
    return differences.orderBy(F.desc_nulls_last("normal_diff"), "column")


def binned_scatter(
    features: DataFrame,
    pairs: Sequence[tuple[str, str]] = SCATTER_PAIRS,
    widths: dict[str, float] | float = 1.0,
) -> DataFrame:
    """Users per (pair, x bin, y bin, churn): the data of a scatter plot at any number of users."""
    width = lambda c: F.lit(float(widths if not isinstance(widths, dict) else widths.get(c, 1.0)))
    edge = lambda c: F.floor(F.col(c) / width(c)) * width(c)
    points = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), edge(x).alias("x_bin"), edge(y).alias("y_bin")) for x, y in pairs
    ]
    return (
        features.select("churn", F.explode(F.array(*points)).alias("p"))
        .groupBy("p.x", "p.y", "p.x_bin", "p.y_bin", "churn")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _per_feature(widths: dict[str, float]) -> Column:
    out = F.lit(1.0)
    for name, w in widths.items():
        out = F.when(F.col("feature") == name, F.lit(float(w))).otherwise(out)
    return out
