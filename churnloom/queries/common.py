"""What the registered queries share: inputs, output types, and SQL building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from churnloom.operators.clean import clean_v1, clean_v2
from churnloom.operators.features import features_v1, features_v2
from churnloom.schema import CHURN_PAGE, NUMERIC_FEATURES, PAGE_COUNTERS
from churnloom.session import cut_lineage
from churnloom.sources.activity_log import LOG_SQL, activity_log

V2_LOG = ["auth", "gender", "itemInSession", "level", "page", "sessionId", "userId", "registration", "ts"]
V1_LOG = ["gender", "itemInSession", "level", "page", "sessionId", "userId", "location", "registration", "ts"]
FEATURE_LOG = [c for c in V2_LOG if c != "auth"]


# Results of one division on exact inputs: equal to the last bit everywhere, so not rounded.
EXACT = {
    "session_h", "acts_per_session", "songs_per_session", "ads_per_session", "init_days_interv",
    "tenure_days_interv", "active_days", "log_ts", "reg_ts", "firstevent_ts", "lastevent_ts",
}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as long, fractions rounded, dates as text: the same in every engine."""
    out = []
    for field in df.schema.fields:
        c = f"`{field.name}`"
        if isinstance(field.dataType, T.IntegralType):
            c = f"CAST({c} AS BIGINT)"
        elif isinstance(field.dataType, T.FractionalType) and field.name not in EXACT:
            # adding 0 turns a rounded -0.0 into 0.0
            c = f"round(CAST({c} AS DOUBLE), {digits}) + 0D"
        elif isinstance(field.dataType, T.DateType):
            c = f"CAST({c} AS STRING)"
        out.append(f"{c} AS `{field.name}`")
    return df.selectExpr(*out)


def v2_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_v2(clean_v2(activity_log(spark, sf_dir, FEATURE_LOG)))


def v1_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_v1(clean_v1(activity_log(spark, sf_dir, V1_LOG)))


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The V2 features as a stored table, for queries that read them more than once."""
    return cut_lineage(v2_features(spark, sf_dir), "features")


# ---- SQL side -------------------------------------------------------------------------------

ORDER_SQL = '(CAST(ts AS HUGEINT) * 9223372036854775808 + coalesce("itemInSession", 0)) * 2'

CLEAN_SQL = """
clean AS (
  SELECT *, CAST(ts AS DOUBLE) / 1000 AS log_ts, CAST(registration AS DOUBLE) / 1000 AS reg_ts FROM log WHERE "userId" <> ''
),
pre AS (
  SELECT *,
    min(log_ts) OVER (PARTITION BY "userId") AS firstevent_ts,
    max(log_ts) OVER (PARTITION BY "userId") AS lastevent_ts,
    (max(log_ts) OVER (PARTITION BY "sessionId", "userId") - min(log_ts) OVER (PARTITION BY "sessionId", "userId")) / 3600
      AS session_h,
    CAST(max(ts) OVER (PARTITION BY "sessionId", "userId") - min(ts) OVER (PARTITION BY "sessionId", "userId") AS DOUBLE)
      / 3600000 AS session_ms_h
  FROM clean
)
"""

COUNTS_SQL = ",\n    ".join(f"count(*) FILTER (WHERE page = '{p}') AS {c}" for c, p in PAGE_COUNTERS.items())

_SHARED_SQL = f"""
    {COUNTS_SQL},
    count(DISTINCT "sessionId") AS nr_sessions,
    count(DISTINCT "itemInSession") AS n_acts,
    avg(session_h) AS avg_sess_h,
    CAST(count(DISTINCT "itemInSession") AS DOUBLE) / count(DISTINCT "sessionId") AS acts_per_session,
    CAST(count(*) FILTER (WHERE page = 'NextSong') AS DOUBLE) / count(DISTINCT "sessionId") AS songs_per_session,
    CAST(count(*) FILTER (WHERE page = 'Roll Advert') AS DOUBLE) / count(DISTINCT "sessionId") AS ads_per_session,
    CAST(min({ORDER_SQL} + CASE WHEN gender = 'F' THEN 1 ELSE 0 END) % 2 AS BIGINT) AS gender,
    CAST(max({ORDER_SQL} + CASE WHEN level = 'paid' THEN 1 ELSE 0 END) % 2 AS BIGINT) AS level,
    CAST(max({ORDER_SQL} + CASE WHEN page = 'Downgrade' THEN 1 ELSE 0 END) % 2 AS BIGINT) AS downgrade,
    CAST(max(CASE WHEN page = '{CHURN_PAGE}' THEN 1 ELSE 0 END) AS BIGINT) AS churn"""

FEATURES_SQL = f"""
feat AS (
  SELECT "userId", {_SHARED_SQL},
    CAST(floor(max(firstevent_ts)) - floor(max(reg_ts)) AS DOUBLE) / 86400 AS init_days_interv,
    CAST(floor(max(lastevent_ts)) - floor(max(reg_ts)) AS DOUBLE) / 86400 AS tenure_days_interv,
    CAST(floor(max(lastevent_ts)) - floor(max(firstevent_ts)) AS DOUBLE) / 86400 AS active_days
  FROM pre GROUP BY "userId"
)
"""

_DAY = "CAST(make_timestamp(({}) * 1000000) AS DATE)"
FEATURES_V1_SQL = f"""
feat AS (
  SELECT "userId", {_SHARED_SQL.replace('session_h)', 'session_ms_h)')},
    date_diff('day', {_DAY.format("max(registration) // 1000")}, {_DAY.format("min(ts) // 1000")}) AS init_days_interv,
    date_diff('day', {_DAY.format("max(registration) // 1000")}, {_DAY.format("max(ts) // 1000")}) AS tenure_days_interv,
    count(DISTINCT {_DAY.format("ts // 1000")}) AS active_days
  FROM pre GROUP BY "userId"
)
"""

DIGEST_SQL = "md5('1234:' || \"userId\")"


def sql_log(select: str, *ctes: str) -> str:
    return "WITH " + ",".join([LOG_SQL, *ctes]) + select


def sql_features(select: str, *ctes: str) -> str:
    return sql_log(select, CLEAN_SQL, FEATURES_SQL, *ctes)


def sql_features_v1(select: str, *ctes: str) -> str:
    return sql_log(select, CLEAN_SQL, FEATURES_V1_SQL, *ctes)


def rounded(columns: list[str]) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in columns)


def text_time(ms: str) -> str:
    return f"strftime(make_timestamp(({ms} // 1000) * 1000000), '%Y-%m-%d %H:%M:%S')"


def tall(columns: list[str], source: str = "feat", ids: tuple[str, ...] = ("churn",)) -> str:
    """CTE ``tall`` with one row per (row, feature)."""
    keep = ", ".join(f'"{i}"' for i in ids)
    parts = [f"SELECT {keep}, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns]
    return "tall AS (" + " UNION ALL ".join(parts) + ")"


def split_cte(shares: dict[str, float], source: str = "feat") -> str:
    """CTE ``split`` for an exact-ratio split by class."""
    cut, cases = 0.0, []
    names = list(shares)
    for name in names[:-1]:
        cut = round(cut + shares[name], 10)
        cases.append(f"WHEN rn - 1 < round(CAST({cut} AS DOUBLE) * size) THEN '{name}'")
    return f"""
split AS (
  SELECT *, CASE {' '.join(cases)} ELSE '{names[-1]}' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY {DIGEST_SQL} || ':' || "userId") AS rn,
               count(*) OVER (PARTITION BY churn) AS size FROM {source})
)
"""


V2_COUNT_COLUMNS = [*PAGE_COUNTERS, "nr_sessions", "n_acts"]
V2_DOUBLE_COLUMNS = NUMERIC_FEATURES[13:]


def feature_select(flags: list[str], doubles: list[str] = V2_DOUBLE_COLUMNS, drop: tuple[str, ...] | list[str] = ()) -> str:
    whole = [c for c in [*NUMERIC_FEATURES, *flags] if c not in doubles and c not in drop]
    raw = [c for c in doubles if c not in drop and c in EXACT]
    return ", ".join(['"userId"', *whole, *raw, *filter(None, [rounded([c for c in doubles if c not in drop and c not in EXACT])])])
