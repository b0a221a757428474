"""Preparation stages, classifiers and parameter grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.tuning import ParamGridBuilder

from churnloom.schema import BINARY_V1, BINARY_V2, CONTINUOUS_V1, CONTINUOUS_V2, SEED

INPUTS = {"v1": (BINARY_V1, CONTINUOUS_V1), "v2": (BINARY_V2, CONTINUOUS_V2)}

SHORT_NAMES = ["lr", "dt", "rf", "gbt", "mlpc", "lsvc"]
WITH_PROBABILITY = {"lr", "dt", "rf", "gbt", "mlpc"}

# Parameter grids of the spot check (one point each) and of the tuning runs.
SPOT_CHECK = {
    "lr": {"regParam": [0.0], "elasticNetParam": [0.0]},
    "dt": {"maxDepth": [5], "maxBins": [32]},
    "rf": {"maxDepth": [5], "maxBins": [32], "numTrees": [20]},
    "gbt": {"maxDepth": [5], "maxBins": [32], "maxIter": [20], "stepSize": [0.1]},
    "mlpc": {"maxIter": [100], "blockSize": [128], "stepSize": [0.5]},
    "lsvc": {"regParam": [0.0]},
}
SPOT_CHECK_FULL = SPOT_CHECK | {"mlpc": {"maxIter": [100], "blockSize": [128], "stepSize": [0.03]}}
TUNE_V2_SAMPLE = {
    "gbt": {"maxDepth": [5, 20], "maxBins": [16, 32], "maxIter": [30], "stepSize": [0.5]},
    "mlpc": {"maxIter": [50, 100], "blockSize": [16, 32], "stepSize": [0.5]},
}
TUNE_V2_FULL = {
    "gbt": {"maxDepth": [15], "maxBins": [32], "maxIter": [10, 20], "stepSize": [0.05, 0.1]},
    "mlpc": {"maxIter": [100, 200], "blockSize": [16, 64, 128], "stepSize": [0.01, 0.03, 0.1]},
}
TUNE_V1_SAMPLE = {
    "lr": {"regParam": [0.1, 0.5, 2.0], "elasticNetParam": [0.1, 1.0]},
    "dt": {"maxDepth": [5, 10, 15, 25], "maxBins": [8, 16, 32]},
    "rf": {"maxDepth": [10, 15, 25], "maxBins": [8, 16, 32], "numTrees": [20, 40, 60]},
    "gbt": {"maxDepth": [10, 15, 25], "maxIter": [10, 20, 30], "stepSize": [0.05, 0.1]},
    "mlpc": {"stepSize": [0.01, 0.02, 0.05], "maxIter": [32, 64, 128, 256]},
}
TUNE_V1_FULL = {
    "lr": {"regParam": [0.01, 0.1, 0.5], "elasticNetParam": [0.01, 0.5]},
    "dt": {"maxDepth": [5, 10, 15, 25], "maxBins": [8, 16, 32]},
    "rf": {"maxDepth": [15, 25], "maxBins": [8, 16, 32], "numTrees": [40, 60]},
    "gbt": {"maxDepth": [15, 25], "maxIter": [10, 20], "stepSize": [0.05, 0.1]},
    "mlpc": {"stepSize": [0.03, 0.05], "maxIter": [128, 256]},
}
META_GRID = {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.01, 0.1], "maxIter": [50, 100, 200]}


def label_stage(source: str = "churn", target: str = "label") -> StringIndexer:
    """Index in alphabetical order, so that class 1 stays 1 even when it is the larger class."""
    return StringIndexer(inputCol=source, outputCol=target, stringOrderType="alphabetAsc")


def vector_stages(raw: Sequence[str], scaled: Sequence[str], target: str = "features") -> list[Estimator]:
    """``raw`` as they are, followed by ``scaled`` brought to mean 0 and sample deviation 1."""
    return [
        VectorAssembler(inputCols=list(raw), outputCol="bin_features"),
        VectorAssembler(inputCols=list(scaled), outputCol="cont_features"),
        StandardScaler(inputCol="cont_features", outputCol="cont_scaler", withMean=True, withStd=True),
        VectorAssembler(inputCols=["bin_features", "cont_scaler"], outputCol=target),
    ]


def preparation(inputs: str = "v2") -> Pipeline:
    """Label index and feature vector for one generation of inputs."""
    return Pipeline(stages=[label_stage(), *vector_stages(*INPUTS[inputs])])


def classifier(name: str, inputs: str = "v2", private: bool = False, **columns: str) -> Estimator:
    """One of the six classifiers; ``private`` gives it output columns of its own (for stacking)."""
    cols = {"featuresCol": "features", "labelCol": "label", **columns}
    if private:
        cols |= {"predictionCol": f"pred_{name}", "rawPredictionCol": f"rawPred_{name}"}
        if name in WITH_PROBABILITY:
            cols["probabilityCol"] = f"prob_{name}"
    width = sum(map(len, INPUTS[inputs]))
    make = {
        "lr": LogisticRegression,
        "dt": lambda: DecisionTreeClassifier(seed=SEED),
        "rf": lambda: RandomForestClassifier(seed=SEED),
        "gbt": lambda: GBTClassifier(seed=SEED),
        "mlpc": lambda: MultilayerPerceptronClassifier(layers=[width, 8, 4, 2], seed=SEED),
        "lsvc": LinearSVC,
    }
    estimator = make[name]()
    for param, value in cols.items():
        estimator.set(estimator.getParam(param), value)
    return estimator


def full_estimator(name: str, inputs: str = "v2") -> Pipeline:
    """Preparation and one classifier in a single estimator."""
    return Pipeline(stages=[*preparation(inputs).getStages(), classifier(name, inputs)])


def param_maps(estimator: Estimator, axes: dict[str, Sequence]) -> list[dict[Param, object]]:
    """All combinations of ``axes``."""
    grid = ParamGridBuilder()
    for name, values in axes.items():
        grid = grid.addGrid(estimator.getParam(name), list(values))
    return grid.build()
