"""Reading and writing event logs and feature tables (any Hadoop path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from churnloom.schema import LOG_SCHEMA


def read_log(spark: SparkSession, path: str, schema: StructType | None = LOG_SCHEMA) -> DataFrame:
    """JSON-lines event log. The declared schema saves the inference scan; pass ``None`` to infer."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A table written by :func:`write_table`; give ``schema`` for JSON to keep types and order."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> str:
    """Write ``df``; an existing path is an error unless ``mode`` says otherwise.

    JSON keeps null fields so that a re-read with inference sees every column.
    """
    writer = df.write.mode(mode)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(path)
    return path


def write_split(parts: dict[str, DataFrame], paths: dict[str, str], fmt: str = "json") -> dict[str, str]:
    """Write the parts of a split, each to its own path."""
    return {name: write_table(part, paths[name], fmt) for name, part in parts.items()}
