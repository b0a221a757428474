"""Whether a fitted model is what its training rows ask for, told by the rows and the model's numbers alone.

Each certificate is an aggregation over the training rows (``label`` and ``features``, as the model was fitted on): the
gradient of a logistic regression's penalised loss, the class counts of a classification tree's leaves, the mean residuals of a
booster's leaves, a forest's averaged votes. A right model gives zeros.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnloom.schema import KEY


def logistic_violations(rows: DataFrame, coefficients: Sequence[float], intercept: float, reg: float = 0.0, elastic: float = 0.0) -> DataFrame:
    """(position, violation): how far each coefficient is from optimal; position -1 is the intercept.

    The penalty works on coefficients of standardised inputs. Where a coefficient is 0 the slope may be anything up to the
    weight of the absolute penalty; elsewhere it must vanish. Inputs that do not vary have coefficient 0 and no violation.
    """
    x = vector_to_array("features")
    entries = rows.select(F.col("label"), x.alias("_x"))
    margin = reduce(lambda a, b: a + b, [F.col("_x")[j] * float(c) for j, c in enumerate(coefficients)], F.lit(float(intercept)))
    off = entries.withColumn("_off", 1 / (1 + F.exp(-margin)) - F.col("label"))
    slopes = [F.avg(F.col("_off") * F.col("_x")[j]).alias(f"g{j}") for j in range(len(coefficients))]
    spreads = [F.stddev_samp(F.col("_x")[j]).alias(f"s{j}") for j in range(len(coefficients))]
    sums = off.agg(F.avg("_off").alias("g"), *slopes, *spreads)
    cells = [F.struct(F.lit(-1).cast("bigint").alias("position"), F.abs("g").alias("violation"))]
    for j, c in enumerate(coefficients):
        cells.append(F.struct(F.lit(j).cast("bigint").alias("position"), _violation(float(c), F.col(f"g{j}"), F.col(f"s{j}"), reg, elastic).alias("violation")))
    return sums.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def _violation(coefficient: float, slope: Column, spread: Column, reg: float, elastic: float) -> Column:
    scaled = slope / spread + reg * (1 - elastic) * coefficient * spread
    if coefficient:
        found = F.abs(scaled + (reg * elastic if coefficient > 0 else -reg * elastic))
    else:
        found = F.greatest(F.abs(scaled) - reg * elastic, F.lit(0.0))
    return F.when(spread > 0, found).otherwise(0.0 if coefficient == 0 else abs(coefficient))


def reached_leaves(rows: DataFrame, nodes: DataFrame, depth: int, trees: int = 1) -> DataFrame:
    """(key, label, tree, node, prediction, stats): the leaf of every tree that each row reaches.

    All rows go down one level at a time, as joins with the (small) node table.
    """
    at = rows.select(KEY, "label", vector_to_array("features").alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    at = at.withColumn("node", F.lit(0))
    below = F.when(F.col("left") < 0, F.col("node")).when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
    splits = nodes.select("tree", "node", "feature", "threshold", "left", "right")
    for _ in range(depth):
        at = at.join(splits, ["tree", "node"]).select(KEY, "label", "_x", "tree", below.alias("node"))
    return at.join(nodes.select("tree", "node", "prediction", "stats"), ["tree", "node"]).drop("_x")


def leaf_recount(reached: DataFrame, nodes: DataFrame) -> DataFrame:
    """(label, n, bad_leaves) of one classification tree: rows its leaves claim, and leaves whose class counts are wrong."""
    leaves = nodes.where(F.col("left") < 0).select("node", F.posexplode("stats").alias("label", "claimed"))
    leaves = leaves.withColumn("label", F.col("label").cast("double"))
    counted = reached.groupBy("node", "label").agg(F.count(F.lit(1)).alias("counted"))
    both = leaves.join(counted, ["node", "label"], "full").fillna(0, ["claimed", "counted"])
    return both.groupBy("label").agg(
        F.sum("claimed").cast("bigint").alias("n"), F.count_if(F.abs(F.col("claimed") - F.col("counted")) > 0).alias("bad_leaves")
    )


def residual_errors(reached: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(tree, n, worst) of a booster: rows per tree, and the largest gap between a leaf and the mean residual of its rows.

    The first tree learns the labels as -1 and 1, every other one the negative gradient of the logistic loss at the margin of
    the trees before it.
    """
    y = 2 * F.col("label") - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("tree") + 1)
    earlier = Window.partitionBy(KEY).orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    margin = F.sum(weight * F.col("prediction")).over(earlier)
    rows = reached.withColumn("_margin", margin)
    residual = F.when(F.col("tree") == 0, y).otherwise(4 * y / (1 + F.exp(2 * y * F.col("_margin"))))
    leaves = rows.groupBy("tree", "node", "prediction").agg(F.avg(residual).alias("mean"), F.count(F.lit(1)).alias("n"))
    return leaves.groupBy("tree").agg(F.sum("n").alias("n"), F.max(F.abs(F.col("mean") - F.col("prediction"))).alias("worst"))


def vote_errors(reached: DataFrame, scored: DataFrame) -> DataFrame:
    """(label, n, worst) of a forest: the largest gap between a row's score and the mean class share of its leaves."""
    share = F.col("stats")[1] / (F.col("stats")[0] + F.col("stats")[1])
    votes = reached.groupBy(KEY, "label").agg(F.avg(share).alias("share"))
    both = votes.join(scored.select(KEY, "score"), KEY)
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("share") - F.col("score"))).alias("worst"))
