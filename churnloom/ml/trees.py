"""Fitted trees as tables and as prefixes of an ensemble."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnloom.session import copied, run_folder, scratch_path

TREE_MODELS = (DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel)
#: impurity below which the trainer makes a node a leaf at any depth
PURE = 2.0**-52


def tree_nodes(model: Model) -> DataFrame:
    """One row per node: tree, node, feature, threshold, left, right (-1 at a leaf), prediction, impurity, stats, gain.

    Read from the stored form of the model. Features are taken as continuous: a row goes left if its value is
    at most ``threshold``. ``stats`` are what the trainer counted: rows by class for a classification tree.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "model")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    return data.select(
        "tree",
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        "prediction",
        "impurity",
        F.col("impurityStats").alias("stats"),
        "gain",
    )


def fully_grown(model: Model, max_depth: int) -> bool:
    """Whether a higher depth limit than ``max_depth`` would have given the same trees.

    So it is if no leaf is impure. Boosted trees are regression trees, whose splits all set different means apart and
    are never merged again, so there it is enough that none reaches the limit. (Leaves of one class are merged in
    classification trees: their depth does not tell how far they grew.)
    """
    if isinstance(model, GBTClassificationModel) and max(t.depth for t in model.trees) < max_depth:
        return True
    with run_folder(SparkSession.active(), "grown"):
        return tree_nodes(model).where((F.col("left") < 0) & (F.abs("impurity") >= PURE)).isEmpty()


def prefix(model: GBTClassificationModel, trees: int) -> GBTClassificationModel:
    """The first ``trees`` trees of a boosted ensemble, as a model that scores with them alone.

    Boosting adds trees one by one, each from the same seed, so this is the model that a fit with
    ``maxIter = trees`` gives.
    """
    if trees >= model.getNumTrees:
        return model
    sc = SparkSession.active().sparkContext
    jvm, java = sc._jvm, model._java_obj
    kept = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, trees)
    weights = sc._gateway.new_array(jvm.double, trees)
    for k in range(trees):
        kept[k], weights[k] = java.trees()[k], java.treeWeights()[k]
    short = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{model.uid}_{trees}", kept, weights))
    for column in ("featuresCol", "predictionCol", "rawPredictionCol", "probabilityCol"):
        short.set(short.getParam(column), model.getOrDefault(column))
    short._transfer_params_to_java()
    return short


def shallower(model: RandomForestClassificationModel, limits: Sequence[int]) -> dict[int, RandomForestClassificationModel]:
    """For each lower depth limit, the forest that a fit with that limit gives: the trees of ``model`` cut there.

    A forest is grown level by level. What a node draws and counts does not depend on the limit as long as all open nodes of a
    level are worked on together. The trainer does so up to ``maxMemoryInMB``; limits beyond levels that may have taken more
    are left out. Nodes at the limit become leaves; then, as the trainer does, sibling leaves of one class are merged.
    """
    spark = SparkSession.active()
    with run_folder(spark, "cut") as folder:
        whole = f"{folder}/whole"
        model.write().save(whole)
        data = spark.read.parquet(f"{whole}/data")
        nodes = data.select(
            F.col("treeID").alias("tree"),
            *[F.col(f"nodeData.{old}").alias(new) for old, new in {"id": "node", "leftChild": "left", "rightChild": "right", "prediction": "prediction", "impurity": "impurity"}.items()],
            F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda a, x: a + x).alias("rows"),
        )
        wide = nodes.groupBy("tree").applyInPandas(_open_nodes, "level int, open double").groupBy("level").agg(F.sum("open")).collect()
        width = model.numFeatures if model.getFeatureSubsetStrategy() != "auto" else math.ceil(math.sqrt(model.numFeatures))
        together = model.getMaxMemoryInMB() * 2**20 // (8 * (model.numClasses + 1) * model.getMaxBins() * width)
        first_apart = min((level for level, n in wide if n > together), default=math.inf)
        depth, out = max(level for level, _ in wide), {}
        for limit in limits:
            if limit > first_apart:
                continue
            if depth <= limit:
                out[limit] = model
                continue
            kept = nodes.groupBy("tree").applyInPandas(_cut_at(limit), "tree int, node int, id int, l int, r int")
            both = data.join(kept, (F.col("treeID") == F.col("tree")) & (F.col("nodeData.id") == F.col("node")))
            leaf, node = F.col("l") < 0, F.col("nodeData")
            split = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
            changed = {"id": F.col("id"), "gain": F.when(leaf, -1.0).otherwise(node["gain"]), "leftChild": F.col("l"), "rightChild": F.col("r"), "split": F.when(leaf, split).otherwise(node["split"])}
            fields = [changed.get(c, node[c]).alias(c) for c in data.schema["nodeData"].dataType.names]
            short = f"{folder}/cut-{limit}"
            for part in ("metadata", "treesMetadata"):
                copied(spark, f"{whole}/{part}", f"{short}/{part}")
            both.select("treeID", F.struct(*fields).alias("nodeData")).write.parquet(f"{short}/data")
            out[limit] = RandomForestClassificationModel.load(short)
        return out


def _levels(tree: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """Nodes of a tree by number, parents before children, and the level of each."""
    tree = tree.sort_values("node")
    level = np.zeros(len(tree), int)
    for k, (left, right) in enumerate(zip(tree["left"], tree["right"], strict=True)):
        if left >= 0:
            level[[left, right]] = level[k] + 1
    return tree, level


def _open_nodes(tree: pd.DataFrame) -> pd.DataFrame:
    """At most how many nodes of a level were split or tried: an impure leaf may be what is left of a subtree of one class."""
    tree, level = _levels(tree)
    inner = (tree["left"] >= 0).to_numpy()
    doubt = ~inner & (tree["impurity"].abs() >= PURE).to_numpy()
    pairs, at = np.floor(tree["rows"].to_numpy()[doubt] / 2), level[doubt]
    rows = []
    for k in range(int(level.max()) + 1):
        hidden = np.minimum(np.exp2(k - at[at <= k]), pairs[at <= k])
        rows.append((k, float((inner & (level == k)).sum() + hidden.sum())))
    return pd.DataFrame(rows, columns=["level", "open"])


def _cut_at(limit: int):
    """The nodes that stay below a limit, with their new numbers and those of their children (-1 at a leaf)."""

    def run(tree: pd.DataFrame) -> pd.DataFrame:
        tree, level = _levels(tree)
        left, right, guess = (tree[c].to_numpy() for c in ("left", "right", "prediction"))
        leaf = (left < 0) | (level >= limit)
        for k in range(len(tree) - 1, -1, -1):
            leaf[k] = leaf[k] or (leaf[left[k]] and leaf[right[k]] and guess[left[k]] == guess[right[k]])
        kept = np.zeros(len(tree), bool)
        kept[0] = True
        for k in np.flatnonzero(~leaf):
            kept[[left[k], right[k]]] = kept[k]
        number = np.cumsum(kept) - 1
        out = pd.DataFrame({"tree": tree["tree"].to_numpy(), "node": tree["node"].to_numpy(), "id": number, "l": np.where(leaf, -1, number[left]), "r": np.where(leaf, -1, number[right])})
        return out[kept]

    return run
