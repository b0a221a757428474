"""Cleaning of the raw event log: three flavours, one per project generation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.functions.scalars import city, datetime_text, seconds, state


def known_users(log: DataFrame) -> DataFrame:
    """Rows with a user id; blank and null ids go."""
    return log.where(F.col("userId") != "")


def blank_users(log: DataFrame, level: str | None = None) -> DataFrame:
    """Rows with a blank user id, optionally of one subscription level."""
    blank = log.where(F.col("userId") == "")
    return blank if level is None else blank.where(F.col("level") == level)


def clean_v2(log: DataFrame) -> DataFrame:
    """Known users, times in epoch seconds; personal, song and web columns dropped."""
    # fixed values: the dropped columns
    timed = known_users(log).withColumns({"log_ts": seconds("ts"), "reg_ts": seconds("registration")})
    return timed.drop(
        "firstName", "lastName", "location", "artist", "song", "length", "userAgent", "method", "status", "ts", "registration"
    )


def clean_profile(log: DataFrame) -> DataFrame:
    """As V2, but with method and status kept and the times as text."""
    # fixed values: the dropped columns
    timed = known_users(log).withColumns({"date_ts": datetime_text("ts"), "date_reg": datetime_text("registration")})
    return timed.drop("firstName", "lastName", "location", "artist", "song", "length", "userAgent", "registration", "ts")


def clean_v1(log: DataFrame) -> DataFrame:
    """Known users with city, state and text times added; every raw column stays, location included."""
    return known_users(log).withColumns(
        {
            "city": city("location"),
            "state": state("location"),
            "event_ts": datetime_text("ts"),
            "reg_ts": datetime_text("registration"),
        }
    )


def cleaning_report(log: DataFrame) -> DataFrame:
    """Rows before, after and removed, counted in one pass."""
    return log.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col("userId") != "").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
