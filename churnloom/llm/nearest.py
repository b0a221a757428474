"""Approximate nearest neighbours by inner product: collision counting over sorted projections.

Inside a chunk of vectors, the largest inner product is the smallest distance once each vector x carries one more
entry, sqrt(M^2 - |x|^2) with M the chunk's largest norm, and the query a 0 there.

1. Index: every vector of a chunk is projected on PROJECTIONS fixed random directions; each direction keeps
   the chunk's projections as one sorted array. No vector is left out.
2. Search: a window of half-width WIDTH * R is centred on the query's own projection in every array, and the
   vectors inside are counted. Virtual rehashing widens the windows, radius by radius; only what a wider
   window adds at its two ends is counted again. Vectors in at least THRESHOLD windows are
   verified: their inner product is worked out in double precision from the original vector. The first k to reach half
   the threshold are verified as well; they only tell early how far the windows must go.
3. A vector at distance R is in a window with probability 2 * Phi(WIDTH) - 1, so it reaches the threshold
   at radius R with probability 1 - MISS at least; nearer ones more surely. Once R is the distance of the k-th best
   verified vector, no other vector can be nearer but with probability MISS, and the chunk is done.
4. One chunk, a sample of SAMPLE_ENTRIES entries at most, is searched first, from small windows on. The k-th best score
   found there is a floor for each query: in all other chunks the windows open at the floor's distance at
   once, and later chunks of a task start from the best found so far.

Queries are cut into blocks of bounded size; a block is broadcast, meets all vectors where they lie, and its
partial lists are stored before the next block is read. Vectors are never shuffled. Each task gives at most k
rows a query, and the k best of these are kept.

Recall against brute force is measured in the tests (0.9 at least is asked for). There is no cap on candidates:
where distances hardly differ, or many copies of one vector lie at the k-th place, all that pass the threshold are
verified, at worst the whole chunk.

Vectors that are null, empty, zero or hold a null or non-finite entry take no part, nor do rows with a null id.
Vectors of another length than the query's are not its candidates. Ties go to the smaller id. A repeated id is a
candidate as often as it occurs, but never of a query with that id; a repeated query id asks once, with its
smallest vector. Other columns play no part, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnloom.llm.store import only, stored

PROJECTIONS = 128
WIDTH = 1.3
#: chance that a neighbour at the k-th place is not verified
MISS = 0.05
#: factor from one radius to the next
WIDER = 3.0
#: the same once k vectors are verified
FINER = 1.25
#: entries of one chunk of vectors, and of one block of queries
CHUNK_ENTRIES = 1 << 19
BLOCK_ENTRIES = 1 << 22
SAMPLE_ENTRIES = 1 << 19

RESULT = "query_id bigint, vec_id bigint, score double"


def threshold(projections: int, width: float, miss: float) -> int:
    """Largest count that a vector at distance R reaches with probability 1 - miss."""
    p = 2 * NormalDist().cdf(width) - 1
    chance, below = (1 - p) ** projections, 0.0
    for count in range(projections + 1):
        if below + chance > miss:
            return max(1, count)
        below += chance
        chance *= (projections - count) / (count + 1) * p / (1 - p)
    return projections


THRESHOLD = threshold(PROJECTIONS, WIDTH, MISS)


class Chunk:
    """Vectors of one length with a sorted array of projections for each direction."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        # lengths are compared and projected in units of the largest entry, so that no square overflows
        self.unit = float(np.abs(self.x).max())
        scaled = self.x / self.unit
        squares = (scaled * scaled).sum(1)
        self.most = float(squares.max())
        lift = np.sqrt(np.maximum(self.most - squares, 0.0))
        directions = np.random.default_rng(x.shape[1]).normal(size=(x.shape[1] + 1, PROJECTIONS))
        self.directions = directions[:-1]
        places = (scaled @ self.directions + lift[:, None] * directions[-1]).T
        order = np.argsort(places, axis=1, kind="stable")
        # the arrays lie one behind another in one, each moved past the one before it
        self.span = 4.0 * float(np.abs(places).max()) + 1.0
        self.moved = np.arange(PROJECTIONS) * self.span
        self.order = order.ravel()
        self.sorted = (np.take_along_axis(places, order, axis=1) + self.moved[:, None]).ravel()
        self.edges = np.arange(PROJECTIONS) * len(ids)

    def search(self, name: int, q: np.ndarray, k: int, best: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of vectors verified for a query whose k-th best score so far is ``best``."""
        own = q / self.unit
        length = float(own @ own) + self.most
        places = own @ self.directions + self.moved
        n = len(self.ids)
        counts = np.zeros(n, np.int64)
        counts[np.searchsorted(self.ids, name) : np.searchsorted(self.ids, name, side="right")] = -2 * PROJECTIONS  # never its own neighbour
        low = high = np.clip(np.searchsorted(self.sorted, places), self.edges, self.edges + n)
        ids, scores = self.ids[:0], np.empty(0)
        limit = self._distance(best, length)
        radius = limit if limit < np.inf else self._start(places, low, k)
        while True:
            low, high = self._widen(counts, places, low, high, WIDTH * radius)
            found = np.flatnonzero(counts >= THRESHOLD)
            if len(scores) + len(found) < k <= n:
                leading = np.argpartition(counts, n - k)[n - k :]
                if counts[leading].min() >= THRESHOLD // 2:
                    found = leading
            if len(found):
                counts[found] = -2 * PROJECTIONS
                ids = np.concatenate([ids, self.ids[found]])
                # entry by entry, not by BLAS: equal vectors must have equal scores wherever they lie
                scores = np.concatenate([scores, (self.x[found] * q).sum(1)])
                if len(scores) >= k:
                    limit = min(limit, self._distance(float(np.partition(scores, -k)[-k]), length))
            if radius >= limit or (high - low).min() == n:
                return ids, scores
            radius = min(limit, radius * (FINER if len(scores) >= k else WIDER))

    def _distance(self, score: float, length: float) -> float:
        """Distance at which the inner product is ``score`` (a little more, for rounding)."""
        if score == -np.inf:
            return np.inf
        return float(np.sqrt(max(length - 2 * score / self.unit**2, 0.0) + 1e-9 * length))

    def _start(self, places: np.ndarray, at: np.ndarray, k: int) -> float:
        """A radius whose windows hold about k vectors."""
        last = self.edges + len(self.ids) - 1
        left = np.abs(self.sorted[np.clip(at - k, self.edges, last)] - places)
        right = np.abs(self.sorted[np.clip(at + k, self.edges, last)] - places)
        return max(float(np.median(np.minimum(left, right))) / WIDTH, 1e-9 * self.most**0.5)

    def _widen(self, counts: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Count what windows of half-width ``reach`` hold beyond the present ones."""
        ends = self.edges + len(self.ids)
        reach = min(reach, self.span)
        a = np.minimum(np.clip(np.searchsorted(self.sorted, places - reach), self.edges, ends), low)
        b = np.maximum(np.clip(np.searchsorted(self.sorted, places + reach, side="right"), self.edges, ends), high)
        cuts = [self.order[i:j] for i, j in zip(a.tolist(), low.tolist(), strict=True)] + [self.order[i:j] for i, j in zip(high.tolist(), b.tolist(), strict=True)]
        counts += np.bincount(np.concatenate(cuts), minlength=len(counts))
        return a, b


class Best:
    """The k best of every query of a block, over all chunks of a task; ``floors`` are scores that k others reach."""

    def __init__(self, names: np.ndarray, vectors: np.ndarray, k: int, floors: np.ndarray | None = None):
        self.names, self.vectors, self.k = names, vectors, k
        self.floors = np.full(len(names), -np.inf) if floors is None else floors
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * len(names)
        self.scores: list[np.ndarray] = [np.empty(0)] * len(names)

    def add(self, chunk: Chunk) -> None:
        for i, (name, q) in enumerate(zip(self.names.tolist(), self.vectors, strict=True)):
            own = self.scores[i][-1] if len(self.scores[i]) == self.k else -np.inf
            ids, scores = chunk.search(name, q, self.k, max(own, self.floors[i]))
            ids, scores = np.concatenate([self.ids[i], ids]), np.concatenate([self.scores[i], scores])
            top = np.lexsort((ids, -scores))[: self.k]
            self.ids[i], self.scores[i] = ids[top], scores[top]

    def batch(self) -> pa.RecordBatch:
        sizes = [len(s) for s in self.scores]
        columns = [np.repeat(self.names, sizes), np.concatenate(self.ids or [self.names[:0]]), np.concatenate(self.scores or [np.empty(0)])]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])


def _chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[Chunk]:
    """Vectors of one length, packed until they have CHUNK_ENTRIES entries (one at least)."""
    size = max(1, CHUNK_ENTRIES // dim)
    ids, vectors, held = [], [], 0
    for batch in batches:
        for k in range(0, batch.num_rows, size):
            part = batch.slice(k, size)
            ids.append(part.column("vec_id").to_numpy())
            vectors.append(_entries(part.column("v"), dim))
            held += part.num_rows
            if held >= size:
                yield Chunk(np.concatenate(ids), np.concatenate(vectors))
                ids, vectors, held = [], [], 0
    if held:
        yield Chunk(np.concatenate(ids), np.concatenate(vectors))


def taking_part(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v, dim) of the rows that take part."""
    own = only(vectors, **{vec_id: "vec_id", embedding: "v"}).withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    return own.select(F.col("vec_id").cast("bigint").alias("vec_id"), "v", F.size("v").alias("dim"))


def nearest(vectors: DataFrame, is_query: Column, *, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of every row that ``is_query`` picks.

    ``is_query`` is a condition on the column ``vec_id`` (a bigint).
    """
    spark = vectors.sparkSession
    numbered = taking_part(vectors, vec_id, embedding).withColumn("draw", F.xxhash64(F.monotonically_increasing_id()))
    own = stored(numbered, "vectors")
    asked = own.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("q")).select("vec_id", "q.*")
    sizes = asked.groupBy("dim").agg(F.count("*").alias("n"))
    parts = sizes.select("dim", F.ceil(F.col("n") * F.col("dim") / BLOCK_ENTRIES).cast("int").alias("parts"))
    block = F.pmod(F.xxhash64("vec_id"), F.col("parts").cast("bigint")).cast("int")
    queries = stored(asked.join(parts, "dim").withColumn("block", block), "queries")
    out = spark.createDataFrame([], RESULT)
    blocks = queries.select("dim", "block").distinct().orderBy("dim", "block").collect()
    for dim in sorted({b.dim for b in blocks}):
        alike = own.where(F.col("dim") == dim)
        drawn = alike.orderBy("draw").limit(max(1, SAMPLE_ENTRIES // dim)).toArrow()
        last = pc.max(drawn["draw"]).as_py()
        sample = spark.sparkContext.broadcast((drawn["vec_id"].to_numpy(), _entries(drawn["v"], dim)))
        for b in blocks:
            if b.dim == dim:
                mine = queries.where((F.col("dim") == dim) & (F.col("block") == b.block)).select("vec_id", "v")
                near = _in_sample(mine, dim, sample, k)
                out = out.unionByName(near).unionByName(_in_the_rest(alike.where(F.col("draw") > last), dim, mine, near, k))
        sample.unpersist()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _entries(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([np.asarray(c.flatten()) for c in chunks] or [np.empty(0)]).reshape(-1, dim)


def _in_sample(mine: DataFrame, dim: int, sample, k: int) -> DataFrame:
    """Stored neighbours of a block of queries in the sampled chunk; the queries are dealt over the tasks."""

    def run(batches):
        chunk = Chunk(*sample.value)
        for batch in batches:
            best = Best(batch.column("vec_id").to_numpy(), _entries(batch.column("v"), dim), k)
            best.add(chunk)
            yield best.batch()

    tasks = mine.sparkSession.sparkContext.defaultParallelism
    return stored(mine.repartition(tasks).mapInArrow(run, RESULT), "sample")


def _in_the_rest(rest: DataFrame, dim: int, mine: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """Stored partial lists of a block of queries against all vectors that are not in the sample."""
    floors = near.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
    asked = mine.join(floors, mine["vec_id"] == floors["query_id"], "left").select("vec_id", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")).toArrow()
    sent = mine.sparkSession.sparkContext.broadcast((asked["vec_id"].to_numpy(), _entries(asked["v"], dim), k, asked["floor"].to_numpy()))

    def run(batches):
        best = Best(*sent.value)
        for chunk in _chunks(batches, dim):
            best.add(chunk)
        yield best.batch()

    found = stored(rest.select("vec_id", "v").mapInArrow(run, RESULT), "partial")
    sent.unpersist()
    return found
