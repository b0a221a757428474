"""Per-user and per-session marks on event rows (the pre-processing step).

First and last times over an unbounded frame are minima and maxima, so they come from
aggregations that are joined back, instead of from a window that would pull every event of a user
into one task. The marks of a user are added to the session rows first, so the events are joined
once; a very active user's side of that join is split at run time (skew join). A missing session
id is a session of its own for each user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.functions.scalars import calendar_days, cohort_text, elapsed_days
from churnloom.session import cut_lineage


def preprocess_v2(clean: DataFrame) -> DataFrame:
    """V2 cleaned log with cohort, first/last event, day intervals and session hours; raw times dropped."""
    return _marked(clean, session_marks(clean, "log_ts")).select(
        *[c for c in clean.columns if c not in ("log_ts", "reg_ts")],
        cohort_text("reg_ts").alias("reg_date"),
        F.col("_user_first").alias("firstevent_ts"),
        F.col("_user_last").alias("lastevent_ts"),
        elapsed_days("_user_first", "reg_ts").alias("init_days_interv"),
        elapsed_days("_user_last", "reg_ts").alias("tenure_days_interv"),
        elapsed_days("_user_last", "_user_first").alias("active_days"),
        ((F.col("_last") - F.col("_first")) / 3600).alias("session_h"),
    )


def preprocess_v1(clean: DataFrame) -> DataFrame:
    """V1 cleaned log with first/last event text, dates, whole-day intervals, active dates and session hours."""
    marked = _marked(clean, session_marks(clean, "ts", date="event_ts"))
    text = lambda ms: F.from_unixtime(F.floor(F.col(ms) / 1000))
    marked = marked.withColumns({"firstevent_ts": text("_user_first"), "lastevent_ts": text("_user_last")})
    return marked.select(
        *clean.columns,
        "firstevent_ts",
        "lastevent_ts",
        F.to_date("event_ts").alias("date_ts"),
        F.to_date("reg_ts").alias("date_reg"),
        calendar_days("firstevent_ts", "reg_ts").alias("init_days_interv"),
        calendar_days("lastevent_ts", "reg_ts").alias("tenure_days_interv"),
        F.col("_dates").alias("active_days"),
        ((F.col("_last") - F.col("_first")) / (1000 * 3600)).alias("session_h"),
    )


def session_marks(log: DataFrame, time: str, date: str | None = None) -> DataFrame:
    """One row per (user, session) with first and last time, also those of the user over all sessions.

    With ``date``, the user's number of distinct dates as well, from the same aggregation of the events: that aggregation is
    stored, so the log is read once for all marks. User marks and dates come from one aggregation of the stored rows.
    """
    keys = ["userId", "sessionId"]
    day = [F.to_date(date).alias("_date")] if date else []
    base = cut_lineage(log.groupBy(*keys, *day).agg(F.min(time).alias("_first"), F.max(time).alias("_last")), "sessions")
    spans = base.groupBy(*keys).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last")) if date else base
    word, bit = F.expr("shiftright(unix_date(_date), 6)"), F.expr("shiftleft(1L, unix_date(_date) & 63)")
    parts = base.groupBy("userId", *([word.alias("_word")] if date else [])).agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), *([F.bit_or(bit).alias("_bits")] if date else [])
    )
    dates = [F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("bigint").alias("_dates")] if date else []
    users = parts.groupBy("userId").agg(F.min("_first").alias("_user_first"), F.max("_last").alias("_user_last"), *dates)
    return spans.join(users, "userId", "left")


def _marked(log: DataFrame, marks: DataFrame) -> DataFrame:
    marks = marks.withColumnsRenamed({"userId": "_user", "sessionId": "_session"})
    return log.join(marks, (F.col("userId") == F.col("_user")) & F.col("sessionId").eqNullSafe(F.col("_session")), "left")
