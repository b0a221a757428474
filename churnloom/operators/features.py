"""One row of behavioural features per user.

One pass over the cleaned log does all of it. Distinct items (and dates, in V1) are sets of bits: a whole number is the
word ``number >> 6`` and one of that word's 64 bits, exact for any long. Events are first aggregated by
(user, session, words); these few rows are rolled up by (user, session) and, in the same step, by (user, word), where
the bits of all sessions are put together; the last aggregation, by user, adds up sessions and bits. A very active user
weighs no more than others after the first step. All buffers are fixed-width, so this stays hash aggregation.

Flags of the first or last event: events are ordered by time, then item number. Where several
events of a user agree in both, in one session or in several, the last-event flags (level, downgrade) are 1
if any of them has 1, and the first-event flag (gender) is 0 if any of them has 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.functions.scalars import calendar_days, elapsed_days, event_order, flagged
from churnloom.schema import CHURN_PAGE, FLAGS_V1, FLAGS_V2, KEY, NUMERIC_FEATURES, PAGE_COUNTERS


def features_v2(clean: DataFrame, drop_missing: bool = True) -> DataFrame:
    """User features from the V2 cleaned log: elapsed-day intervals, flags gender, level, churn."""
    order = event_order("round(log_ts * 1000)", "itemInSession")
    users = _per_user(clean, order, time="log_ts", reg="reg_ts", hours="(_last - _first) / 3600", distinct={"n_acts": "itemInSession"})
    features = _ratios(users).select(
        KEY,
        *NUMERIC_FEATURES[:-3],
        elapsed_days("_user_first", "_reg").alias("init_days_interv"),
        elapsed_days("_user_last", "_reg").alias("tenure_days_interv"),
        elapsed_days("_user_last", "_user_first").alias("active_days"),
        *FLAGS_V2,
    )
    return features.na.drop("any") if drop_missing else features


def features_v1(clean: DataFrame, drop_missing: bool = True) -> DataFrame:
    """User features from the V1 cleaned log: whole-day intervals, distinct active dates, downgrade flag."""
    distinct = {"n_acts": "itemInSession", "_dates": "CAST(unix_date(to_date(event_ts)) AS BIGINT)"}
    order, hours = event_order("ts", "itemInSession"), "(_last - _first) / (1000 * 3600)"
    users = _per_user(clean, order, time="ts", reg="registration", hours=hours, distinct=distinct)
    date = lambda c: F.to_date(F.from_unixtime(F.floor(F.col(c) / 1000)))
    features = _ratios(users).select(
        KEY,
        *NUMERIC_FEATURES[:-3],
        calendar_days(date("_user_first"), date("_reg")).alias("init_days_interv"),
        calendar_days(date("_user_last"), date("_reg")).alias("tenure_days_interv"),
        F.col("_dates").alias("active_days"),
        *FLAGS_V1,
    )
    return features.na.drop("any") if drop_missing else features


def without(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature table less the columns a relevance study has ruled out."""
    return features.drop(*columns)


def _cells(events: DataFrame, order: str, time: str, reg: str, distinct: dict[str, str]) -> DataFrame:
    """Events by (user, session, word of every number to count): sums, first and last marks, bits of the numbers."""
    numbered = events.withColumns({f"_{name}_word": F.expr(f"shiftright({number}, 6)") for name, number in distinct.items()})
    return numbered.groupBy(KEY, "sessionId", *[f"_{name}_word" for name in distinct]).agg(
        *[F.expr(f"count_if(page = '{p}') AS {c}") for c, p in PAGE_COUNTERS.items()],
        F.expr("count(1) AS _events"),
        F.expr(f"min({time}) AS _first"),
        F.expr(f"max({time}) AS _last"),
        F.expr(f"min({reg}) AS _reg"),
        F.expr(f"min({flagged(order, "gender = 'F'")}) AS _gender"),
        F.expr(f"max({flagged(order, "level = 'paid'")}) AS _level"),
        F.expr(f"max({flagged(order, "page = 'Downgrade'")}) AS _downgrade"),
        F.expr(f"max(CASE WHEN page = '{CHURN_PAGE}' THEN 1 ELSE 0 END) AS _churn"),
        *[F.expr(f"bit_or(shiftleft(1L, CAST({number} & 63 AS INT))) AS _{name}_bits") for name, number in distinct.items()],
    )


_LEAST, _MOST = ("_first", "_reg", "_gender"), ("_last", "_level", "_downgrade", "_churn")


def _per_user(events: DataFrame, order: str, time: str, reg: str, hours: str, distinct: dict[str, str]) -> DataFrame:
    """Sums over sessions, marks, and the number of distinct values behind each name of ``distinct``."""
    cells = _cells(events, order, time, reg, distinct)
    words = [f"_{name}_word" for name in distinct]
    rolled = cells.groupingSets([[KEY, "sessionId"], *[[KEY, w] for w in words]], KEY, "sessionId", *words).agg(
        F.grouping_id().alias("_set"),
        *[F.sum(c).alias(c) for c in (*PAGE_COUNTERS, "_events")],
        *[F.min(c).alias(c) for c in _LEAST],
        *[F.max(c).alias(c) for c in _MOST],
        *[F.bit_or(f"_{name}_bits").alias(f"_{name}_bits") for name in distinct],
    )
    # grouping_id has a bit for each key that a set leaves out: user, session, words
    last = len(words)
    every = (1 << (last + 1)) - 1
    of_session = f"_set = {every & ~(1 << last)}"
    of_word = {name: f"_set = {every & ~(1 << (last - 1 - k))}" for k, name in enumerate(distinct)}
    only = lambda test, value: f"CASE WHEN {test} THEN {value} END"
    last_digit = lambda c: F.expr(f"CAST(pmod({c}, 2BD) AS INT)")
    users = rolled.groupBy(KEY).agg(
        *[F.expr(f"sum({only(of_session, c)}) AS {c}") for c in PAGE_COUNTERS],
        F.expr("count(sessionId) AS nr_sessions"),
        F.expr(f"sum({only(of_session, f'{hours} * _events')}) / sum({only(of_session, '_events')}) AS avg_sess_h"),
        F.expr("min(_first) AS _user_first"),
        F.expr("max(_last) AS _user_last"),
        F.expr("min(_reg) AS _reg"),
        F.expr("min(_gender) AS _gender"),
        F.expr("max(_level) AS _level"),
        F.expr("max(_downgrade) AS _downgrade"),
        F.expr("max(_churn) AS churn"),
        *[F.expr(f"coalesce(sum({only(of_word[name], f'bit_count(_{name}_bits)')}), 0L) AS {name}") for name in distinct],
    )
    return users.withColumns({"gender": last_digit("_gender"), "level": last_digit("_level"), "downgrade": last_digit("_downgrade")})


def _ratios(users: DataFrame) -> DataFrame:
    return users.selectExpr(
        "*",
        "n_acts / nr_sessions AS acts_per_session",
        "nr_songs / nr_sessions AS songs_per_session",
        "nr_ads / nr_sessions AS ads_per_session",
    )
