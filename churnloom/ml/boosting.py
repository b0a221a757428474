"""Boosted trees of many fits side by side: every job works on one tree, or one level of one, of all fits.

A fit of its own runs a job for each level of each tree, so a grid of small fits is all scheduling. Here one table holds
the rows of all fits. Nodes of very many rows are split by aggregations over that table, level by level; when a node has at
most ROWS_PER_NODE rows, one task grows what is below it. Splits, gains, residuals and their order are those of Spark's
trainer, so the trees are the same ones; with several input partitions, sums may differ in the last digits, as they do
between runs there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.ml.trees import PURE
from churnloom.session import cut_lineage, remove, run_folder, scratch_path

#: rows of a node below which one task grows the rest of the tree
ROWS_PER_NODE = 100_000
#: rows of all fits for which there is a task at least
ROWS_PER_TASK = 20_000
#: values of parameters that the growing of trees here stands for
PLAIN = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "minInfoGain": 0.0, "lossType": "logistic"}
AXES = {"maxDepth", "maxBins", "maxIter", "stepSize"}
_STATS = "n double, s double, q double"


@dataclass(frozen=True)
class Fit:
    """A boosted ensemble to be grown: which rows it learns from, and its parameters."""

    fold: int
    depth: int
    bins: int
    step: float


def plain(estimator) -> bool:
    """Whether an estimator is a booster whose fits can be grown side by side."""
    if not isinstance(estimator, GBTClassifier):
        return False
    apart = ("weightCol", "validationIndicatorCol")
    return all(estimator.getOrDefault(n) == v for n, v in PLAIN.items()) and not any(estimator.isDefined(n) and estimator.getOrDefault(n) for n in apart)


def margins(estimator: GBTClassifier, fits: Sequence[Fit], pairs: Sequence[tuple[DataFrame, DataFrame]], label: str, steps: Sequence[int]) -> Iterator[tuple[int, DataFrame]]:
    """For each number of trees in ``steps``, lowest first: that number, and (fit, label, margin) of all held-out rows.

    ``pairs`` are the rows to fit on and the held-out rows of each fold. ``fit`` is the place in ``fits``. A table holds until the next one is asked for.
    """
    spark = pairs[0][0].sparkSession
    with run_folder(spark, "boosted"):
        path = scratch_path(spark, "state")
        _start(estimator, fits, pairs, label).write.parquet(path)
        state = spark.read.parquet(path)
        sizes = [r["count"] for r in state.groupBy("fit").count().collect()]
        parts = max(2 * spark.sparkContext.defaultParallelism, math.ceil(sum(sizes) / ROWS_PER_TASK))
        for tree in range(max(steps)):
            y, margin = F.col("y"), F.col("margin")
            # the exponential function of the trainer: that of SQL may differ in the last digit
            power = F.reflect(F.lit("java.lang.Math"), F.lit("exp"), 2.0 * y * margin).cast("double")
            rows = state.withColumn("r", y if tree == 0 else 4.0 * y / (1.0 + power))
            before, path = path, scratch_path(spark, "state")
            with run_folder(spark, "tree"):
                _grown(rows, fits, parts, tree == 0, max(sizes) > ROWS_PER_NODE).write.parquet(path)
            remove(spark, before)
            state = spark.read.schema(state.schema).parquet(path)
            if tree + 1 in steps:
                yield tree + 1, _weighed(state, fits, tree + 1)


def _weighed(state: DataFrame, fits: Sequence[Fit], trees: int) -> DataFrame:
    """Margins of held-out rows as a fitted ensemble weighs its trees: pure leaves tie but for the order of the sum, which areas depend on."""
    sc, held = state.sparkSession.sparkContext, state.where(~F.col("train")).mapInPandas(_unpacked, "fit int, label double, x array<double>")
    held, out = held.withColumn("x", array_to_vector("x")), []
    for step in sorted({f.step for f in fits}):
        weights = _py2java(sc, Vectors.dense([1.0] + [step] * (trees - 1)))
        java = sc._jvm.org.apache.spark.ml.regression.LinearRegressionModel(f"weights_{step}", weights, 0.0)
        model = LinearRegressionModel(java).setFeaturesCol("x").setPredictionCol("margin")
        out.append(model.transform(held.where(F.col("fit").isin([k for k, f in enumerate(fits) if f.step == step]))).drop("x"))
    return reduce(DataFrame.unionByName, out)


def _unpacked(batches):
    for rows in batches:
        yield pd.DataFrame({"fit": rows["fit"], "label": (rows["y"] + 1) / 2, "x": [np.frombuffer(v) for v in rows["leaves"]]})


def _noted(rows: pd.DataFrame, value: np.ndarray) -> list[bytes]:
    """The leaves' values of held-out rows so far, with those of one more tree."""
    return [old if train else old + v.tobytes() for old, train, v in zip(rows["leaves"], rows["train"], value, strict=True)]


# ---- rows and thresholds ------------------------------------------------------------------------


def _start(estimator: GBTClassifier, fits: Sequence[Fit], pairs: Sequence[tuple[DataFrame, DataFrame]], label: str) -> DataFrame:
    """One row per fit and row of its fold: place, whether it is learnt from, label -1 or 1, bin of every input, margin so far, leaves of a held-out row."""
    out = None
    features = vector_to_array(F.col(estimator.getFeaturesCol())).alias("x")
    for fold in sorted({f.fold for f in fits}):
        mine = [(k, f.bins) for k, f in enumerate(fits) if f.fold == fold]
        cuts = _thresholds(pairs[fold][0], features, {b for _, b in mine}, estimator.getSeed())
        for rows, train in zip(pairs[fold], (True, False), strict=True):
            plain_rows = rows.select(F.monotonically_increasing_id().alias("place"), F.lit(train).alias("train"), (2.0 * F.col(label) - 1.0).alias("y"), features)
            binned = plain_rows.mapInPandas(_binned(mine, cuts), "fit int, place long, train boolean, y double, bins binary, margin double, leaves binary")
            out = binned if out is None else out.unionByName(binned)
    return out


def _thresholds(rows: DataFrame, features, bins: set[int], seed: int) -> dict[int, list[np.ndarray]]:
    """For each limit of bins, the thresholds of every input, from at most about max(10,000, bins squared) rows as the trainer draws them."""
    spark, total = rows.sparkSession, rows.count()
    drawn, out = {}, {}
    for limit in bins:
        wanted = max(limit * limit, 10_000)
        fraction = wanted / total if total > wanted else 1.0
        if fraction not in drawn:
            some = rows
            if fraction < 1:
                draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
                some = DataFrame(spark._jsparkSession.createDataFrame(rows._jdf.rdd().sample(False, fraction, draw), rows._jdf.schema()), spark)
            drawn[fraction] = np.array([r[0] for r in some.select(features).collect()])
        x = drawn[fraction]
        out[limit] = [_cuts(x[:, j], min(limit, total) - 1, fraction * total) for j in range(x.shape[1])]
    return out


def _cuts(values: np.ndarray, most: int, expected: float) -> np.ndarray:
    """At most about ``most`` thresholds between the values of one input, dealt evenly over the rows."""
    level, n = np.unique(values[values != 0], return_counts=True)
    zeros = expected - n.sum()
    n = n.astype(float)
    if zeros > PURE * len(values) * 100:
        at = np.searchsorted(level, 0.0)
        level, n = np.insert(level, at, 0.0), np.insert(n, at, zeros)
    middle = (level[:-1] + level[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = expected / (most + 1)
    chosen, seen, target = [], n[0], stride
    for k in range(1, len(level)):
        before, seen = seen, seen + n[k]
        if abs(before - target) < abs(seen - target):
            chosen.append(middle[k - 1])
            target += stride
    return np.array(chosen)


def _binned(mine: list[tuple[int, int]], cuts: dict[int, list[np.ndarray]]):
    def run(batches):
        for rows in batches:
            if len(rows):
                x = np.stack(rows["x"].to_numpy())
                for fit, limit in mine:
                    codes = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts[limit])], axis=1).astype("<u2")
                    yield pd.DataFrame({"fit": fit, "place": rows["place"], "train": rows["train"], "y": rows["y"], "bins": [c.tobytes() for c in codes], "margin": 0.0, "leaves": b""})

    return run


# ---- one tree of every fit ----------------------------------------------------------------------


def _grown(rows: DataFrame, fits: Sequence[Fit], parts: int, first: bool, large_roots: bool) -> DataFrame:
    """``rows`` with the margin after one more tree."""
    columns = [c for c in rows.columns if c != "r"]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    rows = rows.select("*", F.lit(1).cast("long").alias("node"), *[F.lit(None).cast("double").alias(c) for c in "nsq"])
    leaves = []
    while large := large_roots and _large_nodes(rows):
        found = _large_splits(rows, fits, large)
        names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        routed = cut_lineage(rows.mapInPandas(_routed(fits, large, found, first), f"{names}, ended boolean"), "routed")
        leaves.append(routed.where("ended").select(columns))
        rows = routed.where("NOT ended").drop("ended")
    grown = rows.repartition(parts, "fit", "node").groupBy("fit", "node").applyInPandas(_subtree(fits, first), schema)
    return reduce(DataFrame.unionByName, leaves, grown)


def _large_nodes(rows: DataFrame) -> dict[tuple[int, int], tuple | None]:
    """(n, sum, sum of squares) of the residuals in each node of more than ROWS_PER_NODE rows; none of a root."""
    sizes = rows.groupBy("fit", "node", *"nsq").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > ROWS_PER_NODE)
    return {(r.fit, r.node): None if r.n is None else (r.n, r.s, r.q) for r in sizes.collect()}


def _large_splits(rows: DataFrame, fits: Sequence[Fit], large: dict) -> dict[tuple[int, int], tuple]:
    """Stats and best split of every large node, from its rows counted by input and bin: (stats, feature or -1, bin, left, right)."""
    partial = rows.where("train").mapInPandas(_cells_of(large), f"fit int, node long, feature int, bin int, {_STATS}")
    cells = partial.groupBy("fit", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "nsq"])
    stats = "stats array<double>, feature int, bin int, l array<double>, r array<double>"
    found = cells.groupBy("fit", "node").applyInPandas(_node_split(fits, large), f"fit int, node long, {stats}")
    return {(r.fit, r.node): (r.stats, r.feature, r.bin, r.l, r.r) for r in found.collect()}


def _codes(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["bins"]), "<u2").reshape(len(rows), -1)


def _cells_of(large: dict):
    """Residuals of a batch by node, input and bin."""

    def run(batches):
        for rows in batches:
            keep = [k in large for k in zip(rows["fit"], rows["node"], strict=True)]
            rows = rows[keep]
            if len(rows):
                codes = _codes(rows)
                width = codes.shape[1]
                of = lambda c: np.repeat(rows[c].to_numpy(), width)
                r = of("r")
                cells = pd.DataFrame({"fit": of("fit"), "node": of("node"), "feature": np.tile(np.arange(width), len(rows)), "bin": codes.ravel(), "n": 1.0, "s": r, "q": r * r})
                yield cells.groupby(["fit", "node", "feature", "bin"], as_index=False).sum()

    return run


def _node_split(fits: Sequence[Fit], large: dict):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values(["feature", "bin"])
        fit, node = int(cells["fit"].iloc[0]), int(cells["node"].iloc[0])
        table = [cells[c].to_numpy() for c in ("feature", "bin", "n", "s", "q")]
        known = large[fit, node]
        stats = _root_stats(*table) if known is None else np.array(known)
        split = None if _closed(stats, _level(node), fits[fit].depth) else _best_splits(np.zeros(len(cells), int), *table, stats[:, None])
        row = (fit, node, stats.tolist())
        if split is None or not len(split[0]):
            row += (-1, -1, [], [])
        else:
            _, feature, cut, left, right = split
            row += (int(feature[0]), int(cut[0]), left[:, 0].tolist(), right[:, 0].tolist())
        return pd.DataFrame([row], columns=["fit", "node", "stats", "feature", "bin", "l", "r"])

    return run


def _routed(fits: Sequence[Fit], large: dict, found: dict, first: bool):
    """Rows of large nodes moved to the child they belong to, or ended with their margin."""

    def run(batches):
        for rows in batches:
            rows = rows.reset_index(drop=True).assign(ended=False)
            for (fit, node), at in rows.groupby(["fit", "node"]).indices.items():
                if (fit, node) not in large:
                    continue
                # without rows to learn from, a node keeps the stats it came with
                stats, feature, cut, left, right = found.get((fit, node), (large[fit, node], -1, -1, [], []))
                if feature < 0:
                    value = stats[1] / stats[0]
                    rows.loc[at, "margin"] += value * (1.0 if first else fits[fit].step)
                    rows.loc[at, "leaves"] = pd.Series(_noted(rows.iloc[at], np.full(len(at), value)), index=at, dtype=object)
                    rows.loc[at, "ended"] = True
                    continue
                goes_left = _codes(rows.iloc[at])[:, feature] <= cut
                rows.loc[at, "node"] = np.where(goes_left, 2 * node, 2 * node + 1)
                for c, a, b in zip("nsq", left, right, strict=True):
                    rows.loc[at, c] = np.where(goes_left, a, b)
            yield rows

    return run


def _subtree(fits: Sequence[Fit], first: bool):
    """The tree below one node, grown level by level; all rows of the node get their leaf's value."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        fit, node = fits[rows["fit"].iloc[0]], int(rows["node"].iloc[0])
        codes, r = _codes(rows), rows["r"].to_numpy()
        squares, level = r * r, _level(node)
        learnt = np.flatnonzero(rows["train"].to_numpy())
        # one entry for each row learnt from and input, by input, bin and place
        order = np.argsort(codes[learnt], axis=0, kind="stable")
        row, feature = learnt[order.T.ravel()], np.repeat(np.arange(codes.shape[1]), len(learnt))
        code = codes[row, feature].astype(int)
        known = rows[["n", "s", "q"]].iloc[0].to_numpy(float)
        if np.isnan(known[0]):
            known = _root_stats(*_cells(np.zeros(len(row), int), feature, code, r[row], squares[row])[1:])
        stats, value, at = known[:, None], np.zeros(len(rows)), np.zeros(len(rows), int)
        shut = _closed(stats, level, fit.depth) | (len(learnt) == 0)
        while True:
            # leaves: their rows get the mean residual, open nodes are numbered anew
            inside = np.flatnonzero(at >= 0)
            value[inside] = (stats[1] / stats[0])[at[inside]]
            number = np.where(shut, -1, np.cumsum(~shut) - 1)
            at[inside] = number[at[inside]]
            stats = stats[:, ~shut]
            if not stats.shape[1]:
                break
            still = at[row] >= 0
            row, feature, code = row[still], feature[still], code[still]
            mine = at[row]
            order = np.argsort(mine.astype(np.uint16) if stats.shape[1] < 2**16 else mine, kind="stable")
            entries = row[order]
            cells = _cells(mine[order], feature[order], code[order], r[entries], squares[entries])
            split, by, cut, left, right = _best_splits(*cells, stats)
            child = np.full(stats.shape[1], -1)
            child[split] = 2 * np.arange(len(split))
            place = np.where(at >= 0, child[at], -1)
            inside = np.flatnonzero(place >= 0)
            k = place[inside] // 2
            at = place
            at[inside] += codes[inside, by[k]] > cut[k]
            stats = np.stack([left, right], axis=2).reshape(3, -1)
            level += 1
            shut = _closed(stats, level, fit.depth)
        out = rows.drop(columns=["r", "node", "n", "s", "q"])
        return out.assign(margin=out["margin"] + value * (1.0 if first else fit.step), leaves=_noted(out, value))

    return run


def _level(node: int) -> int:
    """Nodes are numbered from 1, the children of k being 2k and 2k + 1."""
    return node.bit_length() - 1


def _impurity(stats: np.ndarray) -> np.ndarray:
    n, s, q = stats
    return (q - s * s / n) / n


def _closed(stats: np.ndarray, level: int, depth: int):
    """Whether nodes are leaves without a look at their splits; a root never is."""
    return (level > 0) & ((np.abs(_impurity(stats)) < PURE) | (level >= depth))


def _cells(node, feature, code, r, squares):
    """Sums, one after the other, of entries that are sorted by node, input and bin."""
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (feature[1:] != feature[:-1]) | (code[1:] != code[:-1])
    cell, at = np.cumsum(new) - 1, np.flatnonzero(new)
    return node[at], feature[at], code[at], np.bincount(cell).astype(float), np.bincount(cell, r), np.bincount(cell, squares)


def _running(node, feature, n, s, q):
    """Running sums of the cells of every (node, input), the place of the last cell of each cell's (node, input)."""
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (feature[1:] != feature[:-1])
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(node)))
    sums = np.stack([n, s, q])
    for k in range(1, int(length.max(initial=0))):
        at = start[length > k] + k
        sums[:, at] += sums[:, at - 1]
    return sums, (start + length - 1)[np.cumsum(new) - 1]


def _root_stats(feature, code, n, s, q) -> np.ndarray:
    """Stats of a root, put together from the two sides of its first split as the trainer does."""
    sums, last = _running(np.zeros(len(feature), int), feature, n, s, q)
    varied = np.flatnonzero(last != np.arange(len(feature)))
    if not len(varied):
        return sums[:, last[0]]
    total, left = sums[:, last[varied[0]]], sums[:, varied[0]] * (code[varied[0]] == 0)
    return left + (total - left)


def _best_splits(node, feature, code, n, s, q, stats):
    """Nodes with a split that gains: node, input, bin, stats of the left and of the right side. The first of equal splits counts."""
    sums, last = _running(node, feature, n, s, q)
    tried = np.flatnonzero(last != np.arange(len(node)))
    left = sums[:, tried]
    right = sums[:, last[tried]] - left
    of, whole = node[tried], left[0] + right[0]
    gain = _impurity(stats)[of] - left[0] / whole * _impurity(left) - right[0] / whole * _impurity(right)
    if not len(tried):
        return of, of, of, left, right
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    top = np.repeat(np.maximum.reduceat(gain, first), np.diff(np.append(first, len(of))))
    equal = np.flatnonzero((gain == top) & (top > 0))
    best = equal[np.unique(of[equal], return_index=True)[1]]
    return of[best], feature[tried][best], code[tried][best], left[:, best], right[:, best]
