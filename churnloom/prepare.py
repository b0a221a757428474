"""End-to-end data preparation: raw log file to feature splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnloom.operators.clean import clean_v2
from churnloom.operators.features import features_v2, without
from churnloom.operators.split import THREE_WAY_SAMPLE, TRAIN_TEST, parts, stratified_split
from churnloom.session import cut_lineage
from churnloom.sources.log_files import read_log, write_split


def prepare_features(log: DataFrame) -> DataFrame:
    """Raw log to a stored V2 feature table."""
    return cut_lineage(features_v2(clean_v2(log)), "features")


def prepare_splits(spark: SparkSession, path: str, shares: dict[str, float] = THREE_WAY_SAMPLE) -> dict[str, DataFrame]:
    """Read a log file and return its stratified feature splits."""
    split = cut_lineage(stratified_split(prepare_features(read_log(spark, path)), shares), "split")
    return parts(split, list(shares))


def write_train_test(
    spark: SparkSession, log_path: str, train_path: str, test_path: str, drop: list[str] | tuple[str, ...] = (), fmt: str = "json"
) -> dict[str, str]:
    """The batch job: log file in, train and test files out."""
    features = without(prepare_features(read_log(spark, log_path)), drop)
    split = parts(cut_lineage(stratified_split(features), "split"), list(TRAIN_TEST))
    return write_split(split, {"train": train_path, "test": test_path}, fmt)
