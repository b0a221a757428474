"""Profiling of the raw log: counts, shares, distributions and coverage.

Each function is one declarative aggregation; totals for shares come from the counted groups, so
the rows are read once and nothing is counted on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnloom.functions.scalars import calendar_parts, city, datetime_text, missing, state


def size(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


def column_types(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, and how many rows have a value in it."""
    present = _long(df.agg(*[F.count(c).alias(c) for c in df.columns]), "n_present")
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    place = F.array_position(F.array(*[F.lit(c) for c in df.columns]), F.col("column")) - 1
    return present.select(place.alias("position"), "column", types[F.col("column")].alias("type"), "n_present")


def peek(df: DataFrame, n: int = 2) -> DataFrame:
    """Any ``n`` rows, for a look at the data."""
    return df.limit(n)


def keyed_sample(df: DataFrame, n: int, seed: int = 1234) -> DataFrame:
    """The ``n`` rows with the smallest digests: a random sample that is the same under every partitioning.

    Each task keeps its ``n`` smallest, which are merged; nothing is shuffled. Samples of parts of a table, taken together and
    sampled again, give the sample of the whole. The digest is taken of all columns but fractional ones; ties go by all columns, so
    only equal rows are interchangeable. Null is text of its own.
    """
    texts = [F.coalesce(F.col(f.name).cast("string"), F.lit("~")) for f in df.schema.fields if not isinstance(f.dataType, T.FractionalType)]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))
    return df.withColumn("_digest", digest).orderBy("_digest", *df.columns).limit(n).drop("_digest")


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def distinct_by(df: DataFrame, key: str, value: str, name: str = "n") -> DataFrame:
    """Exact number of distinct values per key."""
    return df.groupBy(key).agg(F.countDistinct(value).alias(name))


def top(counts: DataFrame, by: str, n: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` largest rows; ``tie_break`` makes the choice repeatable."""
    return counts.orderBy(F.desc(by), *tie_break).limit(n)


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, nulls left out."""
    return count_by(df.where(F.col(column).isNotNull()), column)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def share_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their percentage of all rows (nulls count in the total only).

    The fraction is rounded to two places before it becomes a percentage.
    """
    counted = count_by(df, column).withColumn("_all", F.sum("n").over(Window.partitionBy()))
    shares = counted.where(F.col(column).isNotNull()).withColumn("percentage", F.round(F.col("n") / F.col("_all"), 2) * 100)
    return shares.drop("_all")


def missing_counts(df: DataFrame) -> DataFrame:
    """Null or NaN values per column, long form, in one pass."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return _long(df.agg(*[F.count_if(missing(c, t)).alias(c) for c, t in kinds.items()]), "n_missing")


def distinct_counts(df: DataFrame, approximate: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct non-null values per column, long form.

    The exact form sends each column's distinct values through one shuffle; the approximate form
    keeps a fixed-size sketch per column instead.
    """
    if approximate:
        return _long(df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in df.columns]), "n_distinct")
    names = F.array(*[F.lit(c) for c in df.columns])
    values = F.array(*[F.col(c).cast("string") for c in df.columns])
    tall = df.select(F.explode(F.arrays_zip(names.alias("column"), values.alias("value"))).alias("r")).select("r.*")
    # narrow rows, equal ones merged before they are shuffled
    counted = tall.distinct().groupBy("column").agg(F.count("value").alias("n_distinct"))
    every = df.sparkSession.range(1).select(F.explode(names).alias("column"))
    return every.join(counted, "column", "left").na.fill(0, ["n_distinct"])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min and max per column, long form, in one pass."""
    stats = {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "stddev": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(F.col(c).cast("double")),
        "max": lambda c: F.max(F.col(c).cast("double")),
    }
    wide = df.agg(*[F.struct(*[f(c).alias(s) for s, f in stats.items()]).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.*")) for c in columns]))
    return wide.select(rows.alias("r")).select("r.*")


def with_place(log: DataFrame) -> DataFrame:
    """Log with ``city`` and ``state`` split off the location."""
    return log.withColumns({"city": city("location"), "state": state("location")})


def with_calendar(log: DataFrame) -> DataFrame:
    """Log with text times and the calendar parts of event and registration."""
    timed = log.withColumns({"event_ts": datetime_text("ts"), "date_reg": datetime_text("registration")})
    return timed.withColumns({**calendar_parts("event_ts", "ts"), **calendar_parts("date_reg", "reg", hour=False)})


def time_coverage(log: DataFrame) -> DataFrame:
    """First and last event, first and last registration, as text."""
    timed = log.select(datetime_text("ts").alias("event_ts"), datetime_text("registration").alias("date_reg"))
    return timed.agg(
        F.min("event_ts").alias("first_event"),
        F.max("event_ts").alias("last_event"),
        F.min("date_reg").alias("first_registration"),
        F.max("date_reg").alias("last_registration"),
    )


def length_histogram(log: DataFrame, width: float = 20.0) -> DataFrame:
    """Songs per ``width`` seconds of length; ``bin`` is the lower edge."""
    return (
        log.where(F.col("length").isNotNull())
        .groupBy((F.floor(F.col("length") / width) * width).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def shared_sessions(log: DataFrame) -> DataFrame:
    """Session ids used by more than one user, with users and events."""
    per_user = count_by(log, "sessionId", "userId")
    return (
        per_user.groupBy("sessionId")
        .agg(F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_events"))
        .where(F.col("n_users") > 1)
    )


def repeated_sessions(log: DataFrame) -> DataFrame:
    """(user, session) groups that do not consist of exactly one event."""
    return count_by(log, "userId", "sessionId").where(F.col("n") != 1)


def status_errors(log: DataFrame, level: str | None = None) -> DataFrame:
    """Events answered with status 404, optionally of one subscription level."""
    errors = log.where(F.col("status") == 404)
    return errors if level is None else errors.where(F.col("level") == level)


def events_where(log: DataFrame, condition: Column) -> DataFrame:
    """Number of events that meet a condition."""
    return log.agg(F.count_if(condition).alias("n"))


def _long(wide: DataFrame, name: str) -> DataFrame:
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(name)) for c in wide.columns]))
    return wide.select(rows.alias("r")).select("r.*")
