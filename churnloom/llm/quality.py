"""Text quality: logistic regression over hashed word n-grams, trained by FTRL-proximal updates.

Features are the runs of letters and digits and the runs of punctuation of the whole text (A-Z
lower-cased), and pairs of neighbours, hashed to ``BUCKETS`` places; a text is the vector of
square roots of its counts, scaled to length 1. Scoring is a sparse dot product in every task.

The model is fitted on at most ``SAMPLE`` labelled rows (a documented bound: sample ids, features and
weights are small whatever the corpus is): of each class those with the smallest hashes of their id, as
many as its share of the labels, but a tenth of the sample if the class has them. Only ids that
have a document are sampled. Texts are featurised by Spark; the updates run in one task over
the bounded sample, in the order of that hash, so reruns agree.

Null and empty texts are scored by the bias alone. Without a label of either class the model
is all zeros (score 0.5), and ``keep_good`` keeps every document and warns. Labels of rows with null
quality or null ids are not used; a repeated label row counts once, conflicting labels of an id count as 0;
of the rows that repeat a labelled id the one with the smallest hash of its text is learnt.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnloom.llm.store import fresh, only, stored
from churnloom.llm.text import NOT_LETTERS, WordHasher, by_size, mix64

BUCKETS = 1 << 20
SAMPLE = 20_000
#: a class has one of so many places of the sample at least, if it has as many labels
LEAST = 10
EPOCHS = 4
KEEP_FROM = 0.7

ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1


def ngrams(texts: pa.Array, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and weight of every feature, text after text, and their numbers."""
    words, counts = hasher(texts)
    places, weights, sizes = [], [], np.zeros(len(counts), np.int64)
    pair = mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) if len(words) > 1 else words[:0]
    ends = np.cumsum(counts)
    for k, (low, high) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
        if low == high:
            continue
        place = np.concatenate([words[low:high], pair[low : high - 1]]) & np.uint64(BUCKETS - 1)
        place.sort()
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        n = np.sqrt(np.diff(np.append(first, len(place))))
        places.append(place[first].astype(np.int32))
        weights.append((n / np.sqrt(len(place))).astype(np.float32))
        sizes[k] = len(first)
    none = np.empty(0, np.int32), np.empty(0, np.float32)
    return (np.concatenate(places), np.concatenate(weights), sizes) if places else (*none, sizes)


class Ftrl:
    """FTRL-proximal logistic regression (per-coordinate rates, L1 and L2), sparse updates."""

    def __init__(self, buckets: int = BUCKETS):
        self.z, self.n = np.zeros(buckets + 1), np.zeros(buckets + 1)

    def _weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self._weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] += g * g

    def weights(self) -> np.ndarray:
        return self._weights(np.arange(len(self.z))).astype(np.float32)


def _sparse(column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_LETTERS, runs=True)
        for batch in batches:
            for part in by_size(batch, column):
                places, weights, sizes = ngrams(part.column(column), hasher)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("y"), pa.ListArray.from_arrays(ends, pa.array(places)), pa.ListArray.from_arrays(ends, pa.array(weights))],
                    ["doc_id", "y", "at", "x"],
                )

    return run


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The updates, in one task, over the bounded sample."""
    held = []
    for batch in batches:
        names, y = batch.column("doc_id").to_numpy(), batch.column("y").to_numpy()
        order = mix64(names.astype(np.int64).view(np.uint64))
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("at")).to_numpy())])
        at, x = (batch.column(c).flatten().to_numpy().copy() for c in ("at", "x"))
        held += [(int(order[k]), int(names[k]), at[a:b], x[a:b], float(y[k])) for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))]
    held.sort(key=lambda r: r[:2])
    model = Ftrl()
    for _ in range(EPOCHS if held else 0):
        for _, _, at, x, y in held:
            model.update(at, x.astype(float), y)
    yield pa.RecordBatch.from_arrays([pa.array([model.weights().tobytes()], pa.binary())], ["weights"])


def shares(counts: dict[float, int], sample: int) -> dict[float, int]:
    """Labels of each class in the sample: by its share, a rare class ``sample / LEAST`` if it has them."""
    total = sum(counts.values())
    if total <= sample:
        return dict(counts)
    least = {y: min(n, sample // LEAST) for y, n in counts.items()}
    raised = {y for y, n in counts.items() if n * sample // total < least[y]}
    rest = sample - sum(least[y] for y in raised)
    common = sum(n for y, n in counts.items() if y not in raised)
    return {y: least[y] if y in raised else n * rest // common for y, n in counts.items()}


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> np.ndarray:
    """Weights (the bias last) from (doc_id, text) and (doc_id, quality)."""
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("double").alias("y"))
    known = stored(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return np.zeros(BUCKETS + 1, np.float32)
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).toPandas() for y, n in sorted(shares(counts, sample).items())]
    few = F.broadcast(spark.createDataFrame(pd.concat(picked), "doc_id bigint, y double"))
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"), "text")).alias("text")
    texts = docs.join(few, "doc_id").groupBy("doc_id", "y").agg(one)
    sparse = texts.mapInArrow(_sparse("text"), "doc_id bigint, y double, at array<int>, x array<float>")
    return np.frombuffer(sparse.repartition(1).mapInArrow(_train, "weights binary").first()["weights"], np.float32)


def score(docs: DataFrame, weights: np.ndarray, *, text: str = "text", into: str = "score") -> DataFrame:
    """All rows with the probability of label 1 in column ``into``."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_LETTERS, runs=True)
        w = model.value
        for batch in batches:
            for part in by_size(batch, text):
                places, x, sizes = ngrams(part.column(text), hasher)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                dot = np.bincount(doc, weights=w[places].astype(float) * x, minlength=len(sizes)) + float(w[-1])
                yield part.set_column(part.schema.get_field_index(into), into, pa.array(1 / (1 + np.exp(-dot))))

    out = docs.withColumn(into, F.lit(None).cast("double"))
    return out.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema]))


def keep_good(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = KEEP_FROM) -> DataFrame:
    """The documents scored ``threshold`` or more, with the columns they came with; all if nothing could be learnt."""
    own = only(docs, **{doc_id: "doc_id", text: "text"}).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    mark = fresh("score")
    weights = fit(own, labels)
    if not weights.any():
        warnings.warn("no labels of two classes for these documents: all are kept", stacklevel=2)
        return docs
    return score(docs, weights, text=text, into=mark).where(F.col(mark) >= threshold).drop(mark)
