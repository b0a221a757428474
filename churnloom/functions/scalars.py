"""Column expressions on log columns."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 24 * 3600


def seconds(ms: str | Column) -> Column:
    """Epoch milliseconds to seconds as double."""
    return _col(ms) / F.lit(1000.0)


def datetime_text(ms: str | Column) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd HH:mm:ss`` text; the milliseconds are cut off."""
    return F.from_unixtime(F.floor(seconds(ms)))


def cohort_text(sec: str | Column) -> Column:
    """Epoch seconds to ``MM-yyyy`` text."""
    return F.from_unixtime(F.floor(_col(sec)), "MM-yyyy")


def elapsed_days(end: str | Column, start: str | Column) -> Column:
    """Days between two epoch seconds; both are cut to whole seconds before subtracting."""
    return (_col(end).cast("long") - _col(start).cast("long")) / F.lit(SECONDS_PER_DAY)


def calendar_days(end: str | Column, start: str | Column) -> Column:
    """Midnights between two dates or timestamps."""
    return F.datediff(_col(end), _col(start))


def calendar_parts(ts: str | Column, suffix: str, hour: bool = True) -> dict[str, Column]:
    """Day of month, weekday name, month number and hour of a timestamp, named ``day_<suffix>`` and so on."""
    at = _col(ts)
    parts = {
        f"day_{suffix}": F.dayofmonth(at),
        f"weekday_{suffix}": F.date_format(at, "EEEE"),
        f"month_{suffix}": F.month(at),
    }
    if hour:
        parts[f"hour_{suffix}"] = F.hour(at)
    return parts


def city(location: str | Column) -> Column:
    return F.get(F.split(_col(location), ","), F.lit(0))


def state(location: str | Column) -> Column:
    """Text between the first and second comma, leading blank included; null without a comma."""
    return F.get(F.split(_col(location), ","), F.lit(1))


def event_order(ms: str, item: str) -> str:
    """SQL text of a number that orders a user's events by time, then by position in the session.

    A decimal of 38 digits holds both in full and is a fixed-width aggregation buffer, so minima and maxima
    of it stay inside hash aggregation. A missing item counts as 0.
    """
    return f"(CAST({ms} AS DECIMAL(20,0)) * {1 << 63}BD + coalesce({item}, 0L))"


def flagged(order: str, flag: str) -> str:
    """SQL text of the order number with a 0/1 flag as its last binary digit."""
    return f"CAST({order} * 2BD + CASE WHEN {flag} THEN 1 ELSE 0 END AS DECIMAL(38,0))"


def missing(name: str, kind: T.DataType) -> Column:
    """Null, or NaN where the type has it."""
    at = F.col(f"`{name}`")
    return at.isNull() | F.isnan(at) if isinstance(kind, (T.DoubleType, T.FloatType)) else at.isNull()


def class_one_score(vector: str | Column) -> Column:
    """Second entry of a probability or raw-prediction vector."""
    return vector_to_array(_col(vector))[1]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
