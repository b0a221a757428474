"""Queries over the user features: the table itself, relevance studies and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.operators import profile as P
from churnloom.operators import relevance as R
from churnloom.operators import split as S
from churnloom.operators.features import without
from churnloom.operators.sketches import rank_certificate
from churnloom.plans import kendall as K
from churnloom.plans.ordered import SKETCH_ACCURACY
from churnloom.prepare import prepare_splits, write_train_test
from churnloom.queries.common import (
    DIGEST_SQL,
    V2_DOUBLE_COLUMNS,
    feature_select,
    sql_features,
    sql_features_v1,
    split_cte,
    stored_features,
    tall,
    tidy,
    v1_features,
    v2_features,
)
from churnloom.schema import (
    FLAGS_V1,
    FLAGS_V2,
    KEY,
    NUMERIC_FEATURES,
    WEAK_COLUMNS_FULL,
    WEAK_COLUMNS_SAMPLE,
)
from churnloom.session import cut_lineage, scratch_path
from churnloom.sources.activity_log import activity_log
from churnloom.sources.log_files import read_table, write_table

HISTOGRAM_WIDTH = 5.0
HISTOGRAM_FULL = [c for c in R.HISTOGRAM_SAMPLE if c != "nr_error"]
SCATTER_WIDTHS = {"avg_sess_h": 0.5, "nr_songs": 5.0}
MATRIX_COLUMNS = [*NUMERIC_FEATURES, *FLAGS_V2]


def _features(build):
    return lambda spark, sf_dir: tidy(build(v2_features(spark, sf_dir)))


def _stored(build):
    return lambda spark, sf_dir: tidy(build(stored_features(spark, sf_dir)))


def _stored_v1(build):
    return lambda spark, sf_dir: tidy(build(cut_lineage(v1_features(spark, sf_dir), "features")))


def _train(features: DataFrame) -> DataFrame:
    return cut_lineage(S.part(S.stratified_split(features), "train"), "train")


def _on_train(build):
    return lambda spark, sf_dir: tidy(build(_train(stored_features(spark, sf_dir))))


def _medians_checked(features: DataFrame) -> DataFrame:
    """Whether the approximate class medians have the ranks that their sketch promises."""
    medians = R.class_medians(features, NUMERIC_FEATURES, approximate=True)
    rows = R.long_features(features, NUMERIC_FEATURES)
    found = medians.select("feature", "churn", F.array("median").alias("quantiles"))
    return rank_certificate(rows, "value", ["feature", "churn"], found, [0.5], 1 / SKETCH_ACCURACY).drop("prob")


def _pairs(train: DataFrame, target: str | None = None) -> DataFrame:
    return K.kendall_pairs(train, MATRIX_COLUMNS, KEY, target)


def _with_churn(train: DataFrame) -> DataFrame:
    return K.ranks_with(_pairs(train, "churn"))


def _prepared_splits(shares):
    def query(spark, sf_dir):
        path = write_table(activity_log(spark, sf_dir), scratch_path(spark, "log-json"))
        made = prepare_splits(spark, path, shares)
        return tidy(S.stack(*[df.select(KEY, "churn").withColumn("split", F.lit(name)) for name, df in made.items()]))

    return query


def _train_test_files(spark, sf_dir):
    log = write_table(activity_log(spark, sf_dir), scratch_path(spark, "log-json"))
    paths = write_train_test(spark, log, scratch_path(spark, "train"), scratch_path(spark, "test"), WEAK_COLUMNS_FULL)
    schema = without(v2_features(spark, sf_dir), WEAK_COLUMNS_FULL).schema
    back = [read_table(spark, p, "json", schema).withColumn("split", F.lit(name)) for name, p in paths.items()]
    return tidy(S.stack(*back))


QUERIES = {
    # the feature tables
    "features_v2": _features(lambda f: f),
    "features_v1": lambda spark, sf_dir: tidy(v1_features(spark, sf_dir)),
    "features_reduced_sample": _features(lambda f: without(f, WEAK_COLUMNS_SAMPLE)),
    "features_reduced_full": _features(lambda f: without(f, WEAK_COLUMNS_FULL)),
    "feature_missing": _features(P.missing_counts),
    "feature_missing_v1": lambda spark, sf_dir: tidy(P.missing_counts(v1_features(spark, sf_dir))),
    "feature_describe": _features(lambda f: P.describe(f, NUMERIC_FEATURES)),
    "feature_describe_v1": lambda spark, sf_dir: tidy(P.describe(v1_features(spark, sf_dir), NUMERIC_FEATURES)),
    # churn by class
    "churn_counts": _features(lambda f: P.count_by(f, "churn")),
    "churn_rate": _features(R.churn_rate),
    "churn_shares": _stored(R.class_shares),
    "churn_shares_by_gender": _stored(lambda f: R.class_shares(f, "gender")),
    "churn_shares_by_level": _stored(lambda f: R.class_shares(f, "level")),
    "churn_by_gender": _features(lambda f: R.crosstab(f, "churn", "gender").orderBy("churn_gender")),
    "churn_by_level": _features(lambda f: R.crosstab(f, "churn", "level").orderBy("churn_level")),
    # distributions by class
    "class_histograms": _features(lambda f: R.class_histograms(f, R.HISTOGRAM_SAMPLE, HISTOGRAM_WIDTH)),
    "class_histograms_full": _features(lambda f: R.class_histograms(f, HISTOGRAM_FULL, HISTOGRAM_WIDTH)),
    "class_medians": _stored(lambda f: R.class_medians(f, NUMERIC_FEATURES)),
    "class_medians_approx": _features(lambda f: R.class_medians(f, NUMERIC_FEATURES, approximate=True)),
    "class_medians_checked": _stored(_medians_checked),
    "class_five_numbers": _stored(R.five_numbers),
    "binned_scatter": _on_train(lambda f: R.binned_scatter(f, widths=SCATTER_WIDTHS)),
    # relevance
    "median_difference_v2": _on_train(lambda f: R.ranked(R.median_difference(f))),
    "median_difference_v1": _stored_v1(lambda f: R.ranked(R.median_difference(f, zero_minus_one=True))),
    "rank_correlation": _on_train(lambda f: K.kendall_matrix(f, MATRIX_COLUMNS, KEY)),
    "strong_pairs": _on_train(lambda f: K.strong_pairs(_pairs(f))),
    "churn_correlation": _on_train(_with_churn),
    "weak_features_sample": _on_train(lambda f: K.weak_features(_with_churn(f), 0.04)),
    "weak_features_full": _on_train(lambda f: K.weak_features(_with_churn(f), 0.01)),
    # splits
    "split_random": _features(lambda f: S.random_split(f).select(KEY, "churn", "split")),
    "split_stratified": _stored(lambda f: S.stratified_split(f).select(KEY, "churn", "split")),
    "split_three_way_sample": _stored(lambda f: S.stratified_split(f, S.THREE_WAY_SAMPLE).select(KEY, "churn", "split")),
    "split_three_way_full": _stored(lambda f: S.stratified_split(f, S.THREE_WAY_FULL).select(KEY, "churn", "split")),
    "split_sizes": _stored(lambda f: S.split_sizes(S.stratified_split(f))),
    "split_stacked": _stored(
        lambda f: S.stack(*S.parts(S.stratified_split(f), ["train", "test"]).values()).select(KEY, "churn")
    ),
    "majority_accuracy": _stored(lambda f: S.majority_accuracy(S.stratified_split(f))),
    "prepared_splits_sample": _prepared_splits(S.THREE_WAY_SAMPLE),
    "prepared_splits_full": _prepared_splits(S.THREE_WAY_FULL),
    "train_test_files": _train_test_files,
}


# ---- the same questions in SQL ---------------------------------------------------------------

_TRAIN = "train AS (SELECT * FROM split WHERE split = 'train')"
_SPLIT = split_cte(S.TRAIN_TEST)


def _missing_sql(build, columns):
    return build(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS n_missing FROM feat" for c in columns
        )
    )


def _describe_sql(build):
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
        round(CAST(min({c}) AS DOUBLE), 6) AS "min", round(CAST(max({c}) AS DOUBLE), 6) AS "max" FROM feat"""
        for c in NUMERIC_FEATURES
    ]
    return build(" UNION ALL ".join(parts))


def _histogram_sql(columns):
    w = f"CAST({HISTOGRAM_WIDTH} AS DOUBLE)"
    return sql_features(f"SELECT feature, churn, floor(value / {w}) * {w} AS bin, count(*) AS n FROM tall GROUP BY ALL", tall(columns))


_MEDIANS = "med AS (SELECT feature, churn, quantile_cont(value, 0.5) AS m FROM tall GROUP BY ALL)"
_BOTH = """both_m AS (SELECT feature, abs(max(m) FILTER (WHERE churn = 0)) AS m0, abs(max(m) FILTER (WHERE churn = 1)) AS m1
  FROM med GROUP BY feature)"""


def _median_diff_sql(build, gap, source, *ctes):
    return build(
        f"""SELECT 'nd_' || feature AS "column",
          round(CASE WHEN greatest(m0, m1) <> 0 THEN ({gap}) / greatest(m0, m1) END, 6) AS normal_diff FROM both_m""",
        *ctes,
        tall(NUMERIC_FEATURES, source),
        _MEDIANS,
        _BOTH,
    )


def _scatter_sql():
    parts = []
    for x, y in R.SCATTER_PAIRS:
        wx, wy = (f"CAST({SCATTER_WIDTHS.get(c, 1.0)} AS DOUBLE)" for c in (x, y))
        parts.append(
            f"SELECT '{x}' AS x, '{y}' AS y, floor({x} / {wx}) * {wx} AS x_bin, floor({y} / {wy}) * {wy} AS y_bin, churn, "
            "count(*) AS n FROM train GROUP BY ALL"
        )
    return sql_features(" UNION ALL ".join(parts), _SPLIT, _TRAIN)


_ORDER = "CASE feature " + " ".join(f"WHEN '{c}' THEN {k}" for k, c in enumerate(MATRIX_COLUMNS)) + " END"
_KENDALL = (
    _SPLIT,
    _TRAIN,
    tall(MATRIX_COLUMNS, "train", (KEY,)),
    f"""signs AS (
  SELECT a.feature, {_ORDER.replace("feature", "a.feature")} AS k, a."userId" AS u, b."userId" AS v, sign(a.value - b.value) AS s
  FROM tall a JOIN tall b ON a.feature = b.feature AND a."userId" < b."userId"
),
taus AS (
  SELECT p.feature AS feature_a, q.feature AS feature_b, sum(p.s * q.s) / nullif(sqrt(sum(abs(p.s))) * sqrt(sum(abs(q.s))), 0) AS tau
  FROM signs p JOIN signs q ON p.u = q.u AND p.v = q.v AND p.k < q.k
  GROUP BY ALL
)""",
)
_WITH_CHURN = """ranks AS (
  SELECT CASE WHEN feature_a = 'churn' THEN feature_b ELSE feature_a END AS feature, round(tau, 6) AS kendall_corr, tau
  FROM taus WHERE feature_a = 'churn' OR feature_b = 'churn')"""


def _split_sql(shares):
    return sql_features('SELECT "userId", churn, split FROM split', split_cte(shares))


ORACLES = {
    "features_v2": sql_features(f"SELECT {feature_select(FLAGS_V2)} FROM feat"),
    "features_v1": sql_features_v1(f"SELECT {feature_select(FLAGS_V1, V2_DOUBLE_COLUMNS[:-3])} FROM feat"),
    "features_reduced_sample": sql_features(f"SELECT {feature_select(FLAGS_V2, drop=WEAK_COLUMNS_SAMPLE)} FROM feat"),
    "features_reduced_full": sql_features(f"SELECT {feature_select(FLAGS_V2, drop=WEAK_COLUMNS_FULL)} FROM feat"),
    "feature_missing": _missing_sql(sql_features, [KEY, *MATRIX_COLUMNS]),
    "feature_missing_v1": _missing_sql(sql_features_v1, [KEY, *NUMERIC_FEATURES, *FLAGS_V1]),
    "feature_describe": _describe_sql(sql_features),
    "feature_describe_v1": _describe_sql(sql_features_v1),
    "churn_counts": sql_features("SELECT churn, count(*) AS n FROM feat GROUP BY churn"),
    "churn_rate": sql_features("SELECT round(avg(churn), 4) AS churn_rate FROM feat"),
    **{
        name: sql_features(
            f"""SELECT {keys}, count(*) AS n, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM feat) * 100, 6) AS percentage
            FROM feat GROUP BY ALL"""
        )
        for name, keys in {
            "churn_shares": "churn",
            "churn_shares_by_gender": "churn, gender",
            "churn_shares_by_level": "churn, level",
        }.items()
    },
    **{
        f"churn_by_{c}": sql_features(
            f"""SELECT CAST(churn AS VARCHAR) AS churn_{c}, count(*) FILTER (WHERE {c} = 0) AS "0",
            count(*) FILTER (WHERE {c} = 1) AS "1" FROM feat GROUP BY churn ORDER BY 1"""
        )
        for c in ("gender", "level")
    },
    "class_histograms": _histogram_sql(R.HISTOGRAM_SAMPLE),
    "class_histograms_full": _histogram_sql(HISTOGRAM_FULL),
    "class_medians": sql_features(
        "SELECT feature, churn, round(m, 6) AS median FROM med", tall(NUMERIC_FEATURES), _MEDIANS
    ),
    "class_medians_checked": sql_features(
        "SELECT feature, churn, count(*) AS n, true AS close FROM tall GROUP BY ALL", tall(NUMERIC_FEATURES)
    ),
    "class_five_numbers": sql_features(
        """SELECT feature, churn, round(min(value), 6) AS minimum, round(quantile_cont(value, 0.25), 6) AS q1,
        round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3,
        round(max(value), 6) AS maximum FROM tall GROUP BY ALL""",
        tall(R.BOX_FEATURES),
    ),
    "binned_scatter": _scatter_sql(),
    "median_difference_v2": _median_diff_sql(sql_features, "m1 - m0", "train", _SPLIT, _TRAIN),
    "median_difference_v1": _median_diff_sql(sql_features_v1, "m0 - m1", "feat"),
    "rank_correlation": sql_features(
        """SELECT feature_a, feature_b, round(tau, 6) AS tau FROM taus
        UNION ALL SELECT feature_b AS feature_a, feature_a AS feature_b, round(tau, 6) AS tau FROM taus
        UNION ALL SELECT DISTINCT feature AS feature_a, feature AS feature_b, CAST(1 AS DOUBLE) AS tau FROM tall""",
        *_KENDALL,
    ),
    "strong_pairs": sql_features("SELECT feature_a, feature_b, round(tau, 6) AS tau FROM taus WHERE tau > 0.8", *_KENDALL),
    "churn_correlation": sql_features("SELECT feature, kendall_corr FROM ranks", *_KENDALL, _WITH_CHURN),
    "weak_features_sample": sql_features(
        "SELECT feature, kendall_corr FROM ranks WHERE abs(tau) < 0.04", *_KENDALL, _WITH_CHURN
    ),
    "weak_features_full": sql_features(
        "SELECT feature, kendall_corr FROM ranks WHERE abs(tau) < 0.01", *_KENDALL, _WITH_CHURN
    ),
    "split_random": sql_features(
        f"""SELECT "userId", churn, CASE WHEN CAST('0x' || substr({DIGEST_SQL}, 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) < 0.7
        THEN 'train' ELSE 'test' END AS split FROM feat"""
    ),
    "split_stratified": _split_sql(S.TRAIN_TEST),
    "split_three_way_sample": _split_sql(S.THREE_WAY_SAMPLE),
    "split_three_way_full": _split_sql(S.THREE_WAY_FULL),
    "split_sizes": sql_features("SELECT split, churn, count(*) AS n FROM split GROUP BY ALL", _SPLIT),
    "split_stacked": sql_features('SELECT "userId", churn FROM feat'),
    "majority_accuracy": sql_features(
        """SELECT split, count(*) FILTER (WHERE churn = 1) AS n_one, count(*) FILTER (WHERE churn = 0) AS n_zero,
        round(1 - avg(churn), 6) AS accuracy FROM split GROUP BY split""",
        _SPLIT,
    ),
    "prepared_splits_sample": _split_sql(S.THREE_WAY_SAMPLE),
    "prepared_splits_full": _split_sql(S.THREE_WAY_FULL),
    "train_test_files": sql_features(
        f"SELECT {feature_select(FLAGS_V2, drop=WEAK_COLUMNS_FULL)}, split FROM split", _SPLIT
    ),
}
