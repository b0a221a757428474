"""Reproducible train / test / validation splits.

A row's place depends only on its key and the seed, through an md5 digest, never on partitioning
or row order. The same split can be recomputed in any engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom.plans.ordered import hash_bucket, running_totals
from churnloom.schema import KEY, SEED

TRAIN_TEST = {"train": 0.7, "test": 0.3}
# Three-way shares for the sample log and for the full log.
THREE_WAY_SAMPLE = {"train": 0.4, "validation": 0.3, "test": 0.3}
THREE_WAY_FULL = {"train": 0.4, "validation": 0.4, "test": 0.2}


def digest(key: str = KEY, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def random_split(df: DataFrame, shares: dict[str, float] = TRAIN_TEST, key: str = KEY, seed: int = SEED) -> DataFrame:
    """Add ``split`` by the first 32 bits of the digest. No shuffle; sizes vary like coin tosses."""
    point = F.conv(F.substring(digest(key, seed), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return df.withColumn("split", _pick(point, shares, lambda p, cut: p < cut))


def stratified_split(
    df: DataFrame,
    shares: dict[str, float] = TRAIN_TEST,
    by: str = "churn",
    key: str = KEY,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split`` so that each class is divided in the exact ratio (to one row).

    Rows of a class are ranked by digest; ranks come from 4096 digest buckets, not from one sort.
    """
    ranked = class_ranks(df, by, key, seed)
    place = F.col("_rank") - 1
    return ranked.withColumn("split", _pick(place, shares, lambda p, cut: p < F.round(F.lit(cut) * F.col("_size")))).drop(
        "_rank", "_size"
    )


def class_ranks(df: DataFrame, by: str = "churn", key: str = KEY, seed: int = SEED) -> DataFrame:
    """Add ``_rank``, 1.. in digest order inside each class, and ``_size``, the class size. ``key`` is unique."""
    hashed = df.withColumn("_order", F.concat_ws(":", digest(key, seed), F.col(key).cast("string"))).withColumn(
        "_one", F.lit(1).cast("long")
    )
    ranked = running_totals(hashed, [by], "_order", ["_one"], hash_bucket(F.col("_order")))
    return ranked.withColumnsRenamed({"run__one": "_rank", "all__one": "_size"}).drop("_order", "_one")


def part(split: DataFrame, name: str) -> DataFrame:
    return split.where(F.col("split") == name).drop("split")


def parts(split: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: part(split, name) for name in names}


def stack(*tables: DataFrame) -> DataFrame:
    """Union of tables with the same columns."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def split_sizes(split: DataFrame, by: str = "churn") -> DataFrame:
    return split.groupBy("split", by).agg(F.count(F.lit(1)).alias("n"))


def majority_accuracy(split: DataFrame, label: str = "churn") -> DataFrame:
    """Accuracy per split of always answering class 0, with the class counts behind it."""
    return split.groupBy("split").agg(
        F.count_if(F.col(label) == 1).alias("n_one"),
        F.count_if(F.col(label) == 0).alias("n_zero"),
        F.round(1 - F.avg(F.col(label)), 6).alias("accuracy"),
    )


def _pick(point: Column, shares: dict[str, float], below) -> Column:
    names, cut, choice = list(shares), 0.0, None
    for name in names[:-1]:
        cut = round(cut + shares[name], 10)
        test = below(point, cut)
        choice = F.when(test, F.lit(name)) if choice is None else choice.when(test, F.lit(name))
    return choice.otherwise(F.lit(names[-1]))
