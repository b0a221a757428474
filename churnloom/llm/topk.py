"""Exact top-k search by inner product, pruned with multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... equal segments. From the mean and the deviation of each segment
of two vectors follows (Cauchy-Schwarz on the centred parts) a bound on how close they can be:

    dist(q, x)^2 >= sum of len * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2)

The norms are known exactly, so a lower bound of the distance is an upper bound of the inner
product. Bounds go from coarse to fine; a candidate is dropped once its bound is below the k-th
best score found so far, survivors are computed exactly (integers, no rounding).

Vectors are packed into chunks, queries into blocks; every chunk meets every block of the same
dimension, each meeting returns k rows for each query at most, and the best k of these partial lists
are kept. Each meeting comes as one row of its own, of a bounded size; none is broadcast.

Vectors that are null, empty or hold a null or non-finite component take no part, nor do rows with a null
id. Vectors of another dimension than the query's are not its candidates. Ties go to the smaller
id. A repeated id is a candidate as often as it occurs, but never of a query with that id; a
repeated query id asks once, with its smallest vector. A product beyond the range of a long is
returned as the end of that range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnloom.llm.store import only, stored

SCALE = 256
CHUNK = 4096
BLOCK = 8192
#: queries of a block that are worked on at once
QUERIES = 1024
#: meetings of a task, from which on there are more tasks
MEETINGS = 16
#: share of candidates that survive, below which they are looked up query by query
SPARSE = 1 / 16
LEVELS = (1, 2, 4, 8)


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v, dim): components as floor(256 * x), rows that take part only."""
    own = only(vectors, **{vec_id: "vec_id", embedding: "e"}).withColumn("e", F.col("e").cast("array<double>"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0)).where(finite)
    # floor() of a double is a long; a product beyond that stays a double
    scaled = F.transform("e", lambda x: F.floor(x * F.lit(float(SCALE))).cast("double"))
    return own.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("v"), F.size("e").alias("dim"))


def _packed(df: DataFrame, parts: int, key: str) -> DataFrame:
    """The rows of each dimension in so many parts: (dim, key, ids, vs). Every part is put together by a task that holds few of them."""
    dealt = df.select("dim", F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int").alias(key), "vec_id", "v")
    return dealt.repartition(parts, "dim", key).groupBy("dim", key).agg(F.collect_list("vec_id").alias("ids"), F.flatten(F.collect_list("v")).alias("vs"))


def _parts(df: DataFrame, size: int) -> int:
    """Into how many parts of ``size`` rows on average the rows are cut."""
    return max(1, -(-df.count() // size))


def meetings(own: DataFrame, asked: DataFrame) -> DataFrame:
    """(dim, chunk, block, ids, vs, q_ids, q_vs): every chunk of ``own`` with every block of ``asked`` of its dimension.

    Both sides list the meetings they go to, and a meeting is the join key: the meetings of one block, or of one chunk, are dealt
    over all tasks like any others. Neither side is broadcast, and tasks are not put together by size: the listed rows are many
    times as large as the compressed ones that Spark would judge by.
    """
    n_chunks, n_blocks = _parts(own, CHUNK), _parts(asked, BLOCK)
    tasks = min(n_chunks * n_blocks, max(4 * own.sparkSession.sparkContext.defaultParallelism, n_chunks * n_blocks // MEETINGS))
    listed = lambda n, key: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(key)
    dealt = lambda df: df.repartition(max(2, tasks), "dim", "chunk", "block")
    chunks = _packed(own, n_chunks, "chunk").select("*", listed(n_blocks, "block"))
    blocks = _packed(asked, n_blocks, "block").select("*", listed(n_chunks, "chunk"))
    sent = blocks.select("dim", "chunk", "block", F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"))
    return dealt(chunks).join(dealt(sent).hint("merge"), ["dim", "chunk", "block"])


def _bounds(q: np.ndarray, x: np.ndarray, parts: int) -> np.ndarray:
    """Lower bounds of all squared distances at one resolution."""
    left, right = _statistics(q, parts), _statistics(x, parts)
    return (left**2).sum(1)[:, None] + (right**2).sum(1)[None, :] - 2 * left @ right.T


def _statistics(x: np.ndarray, parts: int) -> np.ndarray:
    """Mean and deviation of every segment, by the root of its length."""
    cut = np.array_split(x, parts, axis=1)
    return np.stack([a.shape[1] ** 0.5 * f(a, axis=1) for a in cut for f in (np.mean, np.std)], 1)


def _small(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether no sum of an inner product passes 2^53, so that doubles hold it exactly."""
    return float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**53


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of a query with rows (Python integers where 2^53 is not enough)."""
    if len(x) == 0:
        return np.empty(0, np.int64)
    if _small(q, x):
        return (x @ q).astype(np.int64)
    whole = [int(a) for a in q]
    return np.array([sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in x], object)


def best_in_chunk(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) of the k best of a chunk for every query of a block."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    norms = (q**2).sum(1)[:, None] + (x**2).sum(1)[None, :]
    norms += 2e-9 * norms + 2e-6
    alive, small = ids[None, :] != q_ids[:, None], _small(q, x)
    floor = np.full(len(q), -np.inf)
    for n in [n for n in LEVELS if n <= q.shape[1]]:
        # queries with few candidates left need no finer bounds
        wide = np.flatnonzero(alive.sum(1) > (k if n == LEVELS[0] else 4 * k))
        if not len(wide):
            break
        every = len(wide) == len(q)
        upper = norms - _bounds(q, x, n) if every else norms[wide] - _bounds(q[wide], x, n)
        upper /= 2
        still = alive if every else alive[wide]
        upper[~still] = -np.inf
        first = np.argpartition(upper, len(ids) - k, axis=1)[:, len(ids) - k :]
        known = np.einsum("ij,ikj->ik", q[wide], x[first]) if small else np.array([[float(p) for p in _exact(q[i], x[f])] for i, f in zip(wide, first, strict=True)])
        floor[wide] = np.maximum(floor[wide], known.min(1))
        alive[wide] = still & (upper >= floor[wide, None])
    if not small or alive.mean() < SPARSE:
        return [row for i in range(len(q)) for row in _best(q_ids[i], q[i], ids, x, np.flatnonzero(alive[i]), k)]
    # most survive everywhere, so all products come at once; the k-th highest of each query cuts the rest off
    scores = np.where(alive, q @ x.T, -np.inf)
    if len(ids) > k:
        alive &= scores >= np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k, None]
    query, at = np.nonzero(alive)
    order = np.lexsort((ids[at], -scores[query, at], query))
    query, at = query[order], at[order]
    top = np.arange(len(query)) - np.searchsorted(query, query) < k
    query, at = query[top], at[top]
    return list(zip(q_ids[query].tolist(), ids[at].tolist(), scores[query, at].astype(np.int64).tolist(), strict=True))


def _best(name: int, q: np.ndarray, ids: np.ndarray, x: np.ndarray, mine: np.ndarray, k: int) -> list[tuple]:
    """The k best of some rows for one query."""
    scores = _exact(q, x[mine])
    top = np.lexsort((ids[mine], -scores))[:k] if scores.dtype != object else sorted(range(len(mine)), key=lambda j: (-scores[j], ids[mine[j]]))[:k]
    return [(int(name), int(ids[mine[j]]), max(min(int(scores[j]), 2**63 - 1), -(2**63))) for j in top]


def _meet(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                q_ids, q = np.asarray(row.q_ids), np.asarray(row.q_vs, float).reshape(len(row.q_ids), row.dim)
                ids, x = np.asarray(row.ids), np.asarray(row.vs, float).reshape(len(row.ids), row.dim)
                for low in range(0, len(q), QUERIES):
                    found = best_in_chunk(q_ids[low : low + QUERIES], q[low : low + QUERIES], ids, x, k)
                    yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row that ``is_query`` picks.

    ``is_query`` is a condition on the column ``vec_id`` (a bigint).
    """
    own = stored(whole_vectors(vectors, vec_id, embedding), "vectors")
    asked = own.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("q")).select("vec_id", "q.*")
    partial = meetings(own, asked).mapInPandas(_meet(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
