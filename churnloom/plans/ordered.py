"""Running totals, ranks and quantiles over a whole ordered group, without one task per group.

The idea is the same everywhere: a monotone function, fixed or taken from a quantile sketch of the
data, cuts the order column into buckets; totals per bucket are a plain aggregation; a running sum over those few bucket rows gives each
bucket its starting offset; inside a bucket a window finishes the job. The number of buckets is
limited by the bucket function and not by the data, so the only window that spans a group sees a
bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rank error of a quantile sketch (1 / accuracy), and the cut points of a column in 256 buckets of about the same size
SKETCH_ACCURACY = 10_000
EVEN_CUTS = tuple(k / 256 for k in range(1, 256))


def cuts_below(edges: Column, value: Column, n: int) -> Column:
    """How many of the ``n`` sorted ``edges`` lie below ``value``, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])
    # beyond the last edge there is null, which is not below
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) < value, at + step).otherwise(at))


def even_buckets(
    df: DataFrame, keys: Sequence[str], order: str, cuts: Sequence[float] = EVEN_CUTS, rows: DataFrame | None = None
) -> DataFrame:
    """Add ``_bucket``, monotone in ``order``: which of a group's cut points a row lies between.

    Cut points are the quantiles ``cuts`` of ``order`` in ``rows`` (the same columns, by default ``df`` itself), from a sketch of
    fixed size per group; results built on the buckets do not depend on how accurate it is.
    """
    places = F.array(*[F.lit(float(c)) for c in cuts])
    edges = (df if rows is None else rows).groupBy(*keys).agg(F.percentile_approx(order, places, F.lit(SKETCH_ACCURACY)).alias("_edges"))
    return df.join(edges, list(keys)).select(*df.columns, cuts_below(F.col("_edges"), F.col(order), len(cuts)).alias("_bucket"))


def tall(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per (row, column): ids, ``feature`` and ``value`` as double.

    ``inline`` rather than ``unpivot``: Spark recognises two uses of it as the same and shuffles once.
    """
    rows = ", ".join(f"struct('{c}' AS feature, CAST({c} AS DOUBLE) AS value)" for c in columns)
    return df.selectExpr(*ids, f"inline(array({rows}))")


def hash_bucket(hex_text: Column) -> Column:
    """First three digits of a hex digest: 4096 buckets in digest order."""
    return F.substring(hex_text, 1, 3)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    bucket: Column | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add ``run_<c>``, the sum of ``c`` over the group's rows up to and including this one, and ``all_<c>``, over all.

    ``df`` must hold one row per (keys, order), that is, ties are already added up; neither may be
    null. ``bucket`` must be monotone in ``order``; without it, ``order`` must be a number other than NaN and the buckets
    follow its distribution.
    """
    direction = F.desc if descending else F.asc
    # both sides of the join below carry the same filter, so that Spark computes the input once
    cut = (even_buckets(df, keys, order) if bucket is None else df.withColumn("_bucket", bucket)).where(" AND ".join(f"{c} IS NOT NULL" for c in [*keys, "_bucket"]))
    group = Window.partitionBy(*keys)
    before = group.orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_bucket")
        .agg(*[F.sum(c).alias(f"_in_{c}") for c in sums])
        .select(
            *keys,
            "_bucket",
            *[F.coalesce(F.sum(f"_in_{c}").over(before), F.lit(0)).alias(f"_pre_{c}") for c in sums],
            *[F.sum(f"_in_{c}").over(group).alias(f"all_{c}") for c in sums],
        )
    )
    inside = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return cut.join(offsets, [*keys, "_bucket"]).select(
        *df.columns,
        *[(F.col(f"_pre_{c}") + F.sum(c).over(inside)).alias(f"run_{c}") for c in sums],
        *[f"all_{c}" for c in sums],
    )


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Interpolated quantiles of ``value`` per ``keys``: one row per (keys, prob), column ``quantile``.

    A quantile sketch brackets every wanted position on both sides; values outside of the brackets are only counted, and
    only those in a bucket that holds a wanted position are sorted. Should the sketch be off by more than it promises, the position
    lies in another bucket and is found there. Equal values are counted once, so heavy ties cost nothing.
    """
    numbers = df.select(*keys, F.col(value).cast("double").alias("_v")).where(
        " AND ".join(f"{c} IS NOT NULL" for c in [*keys, "_v"]) + " AND NOT isnan(_v)"
    )
    counts = numbers.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    counts = even_buckets(counts, keys, "_v", _brackets(probs), numbers)
    group = Window.partitionBy(*keys)
    up_to = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = F.col("prob") * (F.col("_total") - 1)
    wanted = (
        counts.groupBy(*keys, "_bucket")
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_upto", F.sum("_in").over(up_to))
        .withColumn("_total", F.sum("_in").over(group))
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_lo", F.floor(position))
        .withColumn("_hi", F.ceil(position))
        .withColumn("_share", position - F.floor(position))
        .withColumn("_pre", F.col("_upto") - F.col("_in"))
        .where(F.col("_lo").between(F.col("_pre"), F.col("_upto") - 1) | F.col("_hi").between(F.col("_pre"), F.col("_upto") - 1))
        .select(*keys, "_bucket", "prob", "_pre", "_lo", "_hi", "_share")
    )
    inside = (
        Window.partitionBy(*keys, "_bucket", "prob").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.col("_end")
    start = end - F.col("_n")
    placed = counts.join(wanted, [*keys, "_bucket"]).withColumn("_end", F.col("_pre") + F.sum("_n").over(inside))
    at = lambda p: F.max(F.when((F.col(p) >= start) & (F.col(p) < end), F.col("_v")))
    return (
        placed.groupBy(*keys, "prob")
        .agg(at("_lo").alias("_vlo"), at("_hi").alias("_vhi"), F.max("_share").alias("_share"))
        .select(*keys, "prob", (F.col("_vlo") * (1 - F.col("_share")) + F.col("_vhi") * F.col("_share")).alias("quantile"))
    )


def _brackets(probs: Sequence[float]) -> list[float]:
    """Twice the sketch's rank error to either side of the wanted positions, and 31 even cuts for what lies between."""
    off = 2 / SKETCH_ACCURACY
    sides = {min(max(p + d, 0.0), 1.0) for p in probs for d in (-off, off)}
    return sorted(sides | {k / 32 for k in range(1, 32)})


def dense_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per ``keys`` with their 0-based rank in column ``rank``."""
    distinct = df.select(*keys, value).distinct().withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(distinct, keys, value, ["_one"])
    return ranked.select(*keys, value, (F.col("run__one") - 1).alias("rank"))
