"""Queries over the raw log: profiling and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnloom.operators import profile as P
from churnloom.operators import sketches as K
from churnloom.operators.clean import blank_users, clean_profile, clean_v1, clean_v2, cleaning_report
from churnloom.operators.sessions import preprocess_v1, preprocess_v2
from churnloom.queries.common import CLEAN_SQL, V1_LOG, V2_LOG, sql_log, text_time, tidy
from churnloom.schema import LOG_COLUMNS
from churnloom.session import cut_lineage, scratch_path
from churnloom.sources.activity_log import activity_log
from churnloom.sources.log_files import read_log, read_table, write_table


def _on(columns, build):
    """A query that applies ``build`` to the log view with these columns."""
    return lambda spark, sf_dir: tidy(build(activity_log(spark, sf_dir, columns)))


def _calendar(log):
    return P.with_calendar(log)


# Columns of the log summary, and to which decimal place its figures are given (times to the second).
DESCRIBED = {"registration": -3, "ts": -3, "length": 6, "itemInSession": 6}


def _to_digits(summary):
    coarse = F.col("column").isin([c for c, digits in DESCRIBED.items() if digits < 0])
    return summary.withColumns({c: F.when(coarse, F.round(c, -3)).otherwise(F.col(c)) for c in ("mean", "stddev", "min", "max")})


#: rows of the keyed sample
SAMPLE_ROWS = 100

MONTH = "date_format({}, 'yyyy-MM')"


def _distinct_checked(log):
    """Distinct values of all days from one stored sketch a day, held against the exact numbers."""
    sketches = cut_lineage(K.daily_distinct(log, LOG_COLUMNS), "sketches")
    return K.distinct_certificate(K.distinct_between(sketches), P.distinct_counts(log))


def _length_quantiles_checked(log):
    """Quartiles of the song length by month from one stored sketch a day, held against their real ranks."""
    sketches = cut_lineage(K.daily_quantiles(log, "length"), "sketches")
    quartiles = K.quantiles_between(sketches, QUARTILES, [F.expr(MONTH.format("day")).alias("month")])
    rows = log.select("length", F.date_format(K.day_of("ts"), "yyyy-MM").alias("month"))
    return K.rank_certificate(rows, "length", ["month"], quartiles, QUARTILES)


QUARTILES = (0.25, 0.5, 0.75)

QUERIES = {
    # size, schema, missing and distinct values
    "log_size": _on(LOG_COLUMNS, P.size),
    "log_peek": _on(LOG_COLUMNS, P.peek),
    "log_sample": _on(LOG_COLUMNS, lambda log: P.keyed_sample(log, SAMPLE_ROWS)),
    "log_types": _on(LOG_COLUMNS, P.column_types),
    "log_missing": _on(LOG_COLUMNS, P.missing_counts),
    "log_distinct": _on(LOG_COLUMNS, P.distinct_counts),
    "log_distinct_approx": _on(LOG_COLUMNS, lambda log: P.distinct_counts(log, approximate=True)),
    "log_distinct_checked": _on(LOG_COLUMNS, _distinct_checked),
    "length_quantiles_checked": _on(["length", "ts"], _length_quantiles_checked),
    "log_describe": _on(list(DESCRIBED), lambda log: _to_digits(P.describe(log, list(DESCRIBED)))),
    "cleaning_report": _on(["userId"], cleaning_report),
    "user_count": _on(["userId"], lambda log: log.agg(F.countDistinct("userId").alias("n_users"))),
    # counts per value
    "events_by_user": _on(["userId"], lambda log: P.count_by(log, "userId")),
    "events_by_name": _on(["userId", "firstName", "lastName"], lambda log: P.count_by(log, "userId", "firstName", "lastName")),
    "events_by_gender": _on(["gender"], lambda log: P.count_by(log, "gender")),
    "events_by_state": _on(["location"], lambda log: P.count_by(P.with_place(log), "state")),
    "events_by_agent": _on(["userAgent"], lambda log: P.count_by(log, "userAgent")),
    "events_by_method": _on(["method"], lambda log: P.count_by(log, "method")),
    "events_by_status": _on(["status"], lambda log: P.count_by(log, "status")),
    "events_by_auth": _on(["auth"], lambda log: P.count_by(log, "auth")),
    "events_by_page": _on(["page"], lambda log: P.count_by(log, "page")),
    "events_by_session_user": _on(["sessionId", "userId"], lambda log: P.count_by(log, "sessionId", "userId")),
    "top_pages": _on(["page"], lambda log: P.top(P.count_by(log, "page"), "n", 22, ["page"])),
    "top_users": _on(["userId"], lambda log: P.top(P.count_by(log, "userId"), "n", 10, ["userId"])),
    "page_values": _on(["page"], lambda log: P.distinct_values(log, "page")),
    "gender_share": _on(["gender"], lambda log: P.share_by(log, "gender")),
    "level_share": _on(["level"], lambda log: P.share_by(log, "level")),
    # value frequencies and song lengths
    "song_frequency": _on(["song"], lambda log: P.value_frequency(log, "song")),
    "artist_frequency": _on(["artist"], lambda log: P.value_frequency(log, "artist")),
    "state_frequency": _on(["location"], lambda log: P.value_frequency(P.with_place(log), "state")),
    "page_frequency_no_songs": _on(["page"], lambda log: P.value_frequency(log.where(F.col("page") != "NextSong"), "page")),
    "length_histogram": _on(["length"], P.length_histogram),
    "length_mean": _on(["length"], lambda log: log.agg(F.avg("length").alias("mean_length"))),
    "long_songs": _on(["length"], lambda log: P.events_where(log, F.col("length") > 1000.0)),
    "songless_events": _on(["song"], lambda log: P.events_where(log, F.col("song").isNull())),
    # distinct counts per value
    "users_by_state": _on(["userId", "location"], lambda log: P.distinct_by(P.with_place(log), "state", "userId")),
    "users_by_agent": _on(["userId", "userAgent"], lambda log: P.distinct_by(log, "userAgent", "userId")),
    "registrations_by_month": _on(
        ["userId", "registration", "ts"], lambda log: P.distinct_by(_calendar(log), "month_reg", "userId")
    ),
    "sessions_by_hour": _on(
        ["sessionId", "registration", "ts"], lambda log: P.distinct_by(_calendar(log), "hour_ts", "sessionId")
    ),
    "sessions_by_weekday": _on(
        ["sessionId", "registration", "ts"], lambda log: P.distinct_by(_calendar(log), "weekday_ts", "sessionId")
    ),
    "sessions_by_month": _on(
        ["sessionId", "registration", "ts"], lambda log: P.distinct_by(_calendar(log), "month_ts", "sessionId")
    ),
    "time_coverage": _on(["registration", "ts"], P.time_coverage),
    # blank users, errors, first items, shared sessions
    "blank_distinct": _on(LOG_COLUMNS, lambda log: P.distinct_counts(blank_users(log))),
    "blank_paid_by_auth": _on(["userId", "level", "auth"], lambda log: P.count_by(blank_users(log, "paid"), "auth")),
    "blank_free_by_auth": _on(["userId", "level", "auth"], lambda log: P.count_by(blank_users(log, "free"), "auth")),
    "blank_by_page": _on(["userId", "page"], lambda log: P.count_by(blank_users(log), "page")),
    "error_distinct": _on(LOG_COLUMNS, lambda log: P.distinct_counts(P.status_errors(log))),
    "error_count": _on(["status"], lambda log: P.events_where(log, F.col("status") == 404)),
    "error_paid_by_user": _on(
        ["status", "level", "userId"], lambda log: P.count_by(P.status_errors(log, "paid"), "userId")
    ),
    "cancelled_events": _on(LOG_COLUMNS, lambda log: log.where(F.col("auth") == "Cancelled")),
    "first_item_missing": _on(LOG_COLUMNS, lambda log: P.missing_counts(log.where(F.col("itemInSession") == 0))),
    "first_item_pages": _on(
        ["itemInSession", "page"], lambda log: P.count_by(log.where(F.col("itemInSession") == 0), "page")
    ),
    "repeated_sessions": _on(["userId", "sessionId"], P.repeated_sessions),
    "shared_sessions": _on(["userId", "sessionId"], P.shared_sessions),
    "session_events": _on(
        ["userId", "sessionId", "page", "registration", "ts"],
        lambda log: _calendar(log).where(F.col("sessionId") == F.lit(3)).select("userId", "page", "event_ts"),
    ),
    "user_events": _on(
        ["userId", "sessionId", "page", "registration", "ts"],
        lambda log: _calendar(log).where(F.col("userId") == "125").select("sessionId", "event_ts", "date_reg", "page"),
    ),
    # scalar functions on every event
    "event_calendar": _on(["userId", "sessionId", "registration", "ts"], _calendar),
    "event_places": _on(["userId", "location"], P.with_place),
    # cleaning and pre-processing
    "clean_v2": _on(LOG_COLUMNS, clean_v2),
    "clean_v1": _on(LOG_COLUMNS, clean_v1),
    "clean_profile": _on(LOG_COLUMNS, clean_profile),
    "clean_missing": _on(LOG_COLUMNS, lambda log: P.missing_counts(clean_profile(log))),
    "preprocess_v2": _on(V2_LOG, lambda log: preprocess_v2(clean_v2(log))),
    "preprocess_v1": _on(V1_LOG, lambda log: preprocess_v1(clean_v1(log))),
}


def _json_round_trip(spark, sf_dir):
    path = write_table(activity_log(spark, sf_dir), scratch_path(spark, "log-json"))
    return tidy(read_log(spark, path))


def _json_inferred(spark, sf_dir):
    path = write_table(activity_log(spark, sf_dir), scratch_path(spark, "log-json"))
    return tidy(read_log(spark, path, schema=None))


def _parquet_round_trip(spark, sf_dir):
    path = write_table(activity_log(spark, sf_dir), scratch_path(spark, "log-parquet"), fmt="parquet")
    return tidy(read_table(spark, path))


QUERIES |= {
    "json_round_trip": _json_round_trip,
    "json_inferred": _json_inferred,
    "parquet_round_trip": _parquet_round_trip,
}


# ---- the same questions in SQL ---------------------------------------------------------------

_LOG = ", ".join(
    f'round({c}, 6) AS "{c}"' if c == "length" else f'"{c}"' for c in LOG_COLUMNS
)
_NOT_IN_V2 = {"firstName", "lastName", "location", "artist", "song", "length", "userAgent", "method", "status", "ts", "registration"}
_V2 = ", ".join(f'"{c}"' for c in LOG_COLUMNS if c not in _NOT_IN_V2)
_CITY = """CASE WHEN location IS NOT NULL THEN str_split(location, ',')[1] END"""
_STATE = """CASE WHEN location IS NOT NULL THEN str_split(location, ',')[2] END"""
_CALENDAR = f"""
cal AS (
  SELECT *, {text_time("ts")} AS event_ts, {text_time("registration")} AS date_reg,
    make_timestamp(ts * 1000) AS ev_at, make_timestamp(registration * 1000) AS reg_at, {_CITY} AS city, {_STATE} AS state
  FROM log
)
"""


def _count(keys, where="", source="log"):
    listed = ", ".join(f'"{k}"' for k in keys)
    return f"SELECT {listed}, count(*) AS n FROM {source} {where} GROUP BY ALL"


def _long_sql(columns, expr, name, source="log"):
    parts = [f"SELECT '{c}' AS \"column\", {expr.format(c=chr(34) + c + chr(34))} AS {name} FROM {source}" for c in columns]
    return " UNION ALL ".join(parts)


_MISSING = "count(*) FILTER (WHERE {c} IS NULL)"
_DISTINCT = "count(DISTINCT {c})"
_PROFILE_COLUMNS = [
    *[c for c in LOG_COLUMNS if c not in _NOT_IN_V2 or c in ("method", "status")],
    "date_ts",
    "date_reg",
]
_PROFILE = (
    f"profiled AS (SELECT *, {text_time('ts')} AS date_ts, {text_time('registration')} AS date_reg FROM log WHERE \"userId\" <> '')"
)


def _describe_sql():
    parts = []
    for c, digits in DESCRIBED.items():
        x = f'CAST("{c}" AS DOUBLE)'
        parts.append(
            f"SELECT '{c}' AS \"column\", count({x}) AS n, round(avg({x}), {digits}) AS mean, round(stddev_samp({x}), {digits}) AS stddev, "
            f"round(min({x}), {digits}) AS \"min\", round(max({x}), {digits}) AS \"max\" FROM log"
        )
    return " UNION ALL ".join(parts)


# The column types of the log, spelled out.
_TYPES = """userId string, firstName string, lastName string, gender string, location string, userAgent string, level string,
registration bigint, artist string, song string, length double, auth string, itemInSession bigint, method string, page string,
sessionId bigint, status bigint, ts bigint"""


def _types_sql():
    parts = [x.split() for x in _TYPES.split(",")]
    return " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS position, '{c}' AS \"column\", '{t}' AS type, count(\"{c}\") AS n_present FROM log" for k, (c, t) in enumerate(parts)
    )


def _sample_sql():
    texts = ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '~')" for c in LOG_COLUMNS if c != "length")
    order = ", ".join(f'"{c}" NULLS FIRST' for c in LOG_COLUMNS)
    return f"SELECT {_LOG} FROM log ORDER BY md5(concat_ws('|', '1234', {texts})), {order} LIMIT {SAMPLE_ROWS}"


def _share_sql(c):
    return (
        f"SELECT {c}, count(*) AS n, round(round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM log), 2) * 100, 6) AS percentage "
        f"FROM log WHERE {c} IS NOT NULL GROUP BY {c}"
    )


_DATE = "CAST(CAST(make_timestamp(({}) * 1000000) AS DATE) AS VARCHAR)"

ORACLES = {
    "log_size": "SELECT count(*) AS n_rows, CAST(18 AS BIGINT) AS n_columns FROM log",
    "log_missing": _long_sql(LOG_COLUMNS, _MISSING, "n_missing"),
    "log_distinct": _long_sql(LOG_COLUMNS, _DISTINCT, "n_distinct"),
    "log_describe": _describe_sql(),
    "log_types": _types_sql(),
    "log_sample": _sample_sql(),
    "log_distinct_checked": _long_sql(LOG_COLUMNS, _DISTINCT, "n_distinct, true AS close"),
    "length_quantiles_checked": """SELECT strftime(make_timestamp((ts // 1000) * 1000000), '%Y-%m') AS month, unnest([0.25::DOUBLE, 0.5, 0.75]) AS prob,
        n, true AS close FROM (SELECT min(ts) AS ts, count(length) AS n FROM log WHERE length IS NOT NULL
          GROUP BY strftime(make_timestamp((ts // 1000) * 1000000), '%Y-%m'))""",
    "cleaning_report": """SELECT count(*) AS rows_before, count(*) FILTER (WHERE "userId" <> '') AS rows_after,
        count(*) - count(*) FILTER (WHERE "userId" <> '') AS rows_removed FROM log""",
    "user_count": 'SELECT count(DISTINCT "userId") AS n_users FROM log',
    "events_by_user": _count(["userId"]),
    "events_by_name": _count(["userId", "firstName", "lastName"]),
    "events_by_gender": _count(["gender"]),
    "events_by_state": _count(["state"], source="cal"),
    "events_by_agent": _count(["userAgent"]),
    "events_by_method": _count(["method"]),
    "events_by_status": _count(["status"]),
    "events_by_auth": _count(["auth"]),
    "events_by_page": _count(["page"]),
    "events_by_session_user": _count(["sessionId", "userId"]),
    "top_pages": _count(["page"]) + " ORDER BY n DESC, page LIMIT 22",
    "top_users": _count(["userId"]) + ' ORDER BY n DESC, "userId" LIMIT 10',
    "page_values": "SELECT DISTINCT page FROM log WHERE page IS NOT NULL",
    "gender_share": _share_sql("gender"),
    "level_share": _share_sql("level"),
    "song_frequency": _count(["song"], "WHERE song IS NOT NULL"),
    "artist_frequency": _count(["artist"], "WHERE artist IS NOT NULL"),
    "state_frequency": _count(["state"], "WHERE state IS NOT NULL", "cal"),
    "page_frequency_no_songs": _count(["page"], "WHERE page <> 'NextSong'"),
    "length_histogram": """SELECT floor(length / 20) * 20 AS bin, count(*) AS n FROM log WHERE length IS NOT NULL GROUP BY 1""",
    "length_mean": "SELECT round(avg(length), 6) AS mean_length FROM log",
    "long_songs": "SELECT count(*) FILTER (WHERE length > 1000) AS n FROM log",
    "songless_events": "SELECT count(*) FILTER (WHERE song IS NULL) AS n FROM log",
    "users_by_state": 'SELECT state, count(DISTINCT "userId") AS n FROM cal GROUP BY state',
    "users_by_agent": 'SELECT "userAgent", count(DISTINCT "userId") AS n FROM log GROUP BY ALL',
    "registrations_by_month": 'SELECT month(reg_at) AS month_reg, count(DISTINCT "userId") AS n FROM cal GROUP BY ALL',
    "sessions_by_hour": 'SELECT hour(ev_at) AS hour_ts, count(DISTINCT "sessionId") AS n FROM cal GROUP BY ALL',
    "sessions_by_weekday": 'SELECT dayname(ev_at) AS weekday_ts, count(DISTINCT "sessionId") AS n FROM cal GROUP BY ALL',
    "sessions_by_month": 'SELECT month(ev_at) AS month_ts, count(DISTINCT "sessionId") AS n FROM cal GROUP BY ALL',
    "time_coverage": """SELECT min(event_ts) AS first_event, max(event_ts) AS last_event,
        min(date_reg) AS first_registration, max(date_reg) AS last_registration FROM cal""",
    "blank_distinct": _long_sql(LOG_COLUMNS, _DISTINCT, "n_distinct", "(SELECT * FROM log WHERE \"userId\" = '')"),
    "blank_paid_by_auth": _count(["auth"], "WHERE \"userId\" = '' AND level = 'paid'"),
    "blank_free_by_auth": _count(["auth"], "WHERE \"userId\" = '' AND level = 'free'"),
    "blank_by_page": _count(["page"], "WHERE \"userId\" = ''"),
    "error_distinct": _long_sql(LOG_COLUMNS, _DISTINCT, "n_distinct", "(SELECT * FROM log WHERE status = 404)"),
    "error_count": "SELECT count(*) FILTER (WHERE status = 404) AS n FROM log",
    "error_paid_by_user": _count(["userId"], "WHERE status = 404 AND level = 'paid'"),
    "cancelled_events": f"SELECT {_LOG} FROM log WHERE auth = 'Cancelled'",
    "first_item_missing": _long_sql(LOG_COLUMNS, _MISSING, "n_missing", '(SELECT * FROM log WHERE "itemInSession" = 0)'),
    "first_item_pages": _count(["page"], 'WHERE "itemInSession" = 0'),
    "repeated_sessions": _count(["userId", "sessionId"]) + " HAVING count(*) <> 1",
    "shared_sessions": """SELECT "sessionId", count(DISTINCT "userId") AS n_users, count(*) AS n_events
        FROM log GROUP BY ALL HAVING count(DISTINCT "userId") > 1""",
    "session_events": 'SELECT "userId", page, event_ts FROM cal WHERE "sessionId" = 3',
    "user_events": """SELECT "sessionId", event_ts, date_reg, page FROM cal WHERE "userId" = '125'""",
    "event_calendar": """SELECT "userId", "sessionId", registration, ts, event_ts, date_reg,
        day(ev_at) AS day_ts, dayname(ev_at) AS weekday_ts, month(ev_at) AS month_ts, hour(ev_at) AS hour_ts,
        day(reg_at) AS day_reg, dayname(reg_at) AS weekday_reg, month(reg_at) AS month_reg FROM cal""",
    "event_places": 'SELECT "userId", location, city, state FROM cal',
    "clean_v2": f"SELECT {_V2}, log_ts, reg_ts FROM clean",
    "clean_v1": f"""SELECT {_LOG}, city, state, event_ts, date_reg AS reg_ts FROM cal WHERE "userId" <> ''""",
    "clean_profile": f"""SELECT {", ".join(f'"{c}"' for c in _PROFILE_COLUMNS)} FROM profiled""",
    "clean_missing": _long_sql(_PROFILE_COLUMNS, _MISSING, "n_missing", "profiled"),
    "preprocess_v2": f"""SELECT {_V2}, strftime(make_timestamp(registration * 1000), '%m-%Y') AS reg_date,
        firstevent_ts, lastevent_ts,
        (floor(firstevent_ts) - floor(reg_ts)) / 86400 AS init_days_interv,
        (floor(lastevent_ts) - floor(reg_ts)) / 86400 AS tenure_days_interv,
        (floor(lastevent_ts) - floor(firstevent_ts)) / 86400 AS active_days,
        session_h FROM pre""",
    "preprocess_v1": f"""SELECT {", ".join(f'"{c}"' for c in V1_LOG)}, {_CITY} AS city, {_STATE} AS state,
        {text_time("ts")} AS event_ts, {text_time("registration")} AS reg_ts,
        {text_time('min(ts) OVER (PARTITION BY "userId")')} AS firstevent_ts,
        {text_time('max(ts) OVER (PARTITION BY "userId")')} AS lastevent_ts,
        {_DATE.format("ts // 1000")} AS date_ts, {_DATE.format("registration // 1000")} AS date_reg,
        date_diff('day', CAST(make_timestamp(registration * 1000) AS DATE),
                  CAST(make_timestamp(1000 * min(ts) OVER (PARTITION BY "userId")) AS DATE)) AS init_days_interv,
        date_diff('day', CAST(make_timestamp(registration * 1000) AS DATE),
                  CAST(make_timestamp(1000 * max(ts) OVER (PARTITION BY "userId")) AS DATE)) AS tenure_days_interv,
        dates AS active_days, session_ms_h AS session_h
        FROM pre JOIN (SELECT "userId", count(DISTINCT CAST(make_timestamp(ts * 1000) AS DATE)) AS dates FROM clean GROUP BY ALL)
          USING ("userId")""",
    "json_round_trip": f"SELECT {_LOG} FROM log",
    "json_inferred": f"SELECT {_LOG} FROM log",
    "parquet_round_trip": f"SELECT {_LOG} FROM log",
}
ORACLES = {name: sql_log(select, CLEAN_SQL, _CALENDAR, _PROFILE) for name, select in ORACLES.items()}
