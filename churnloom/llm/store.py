"""Tables in the folder that all executors share, and names that cannot clash."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and go on from the stored rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns (old=new) under the operator's own names; other columns play no part."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str = "c") -> str:
    """A column name that no input table has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"
