"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

1. Each text becomes its set of word shingles (hashes), a MinHash signature of ``COORDINATES``
   values and a fingerprint of the set. Equal sets are one class; its smallest id stands for it.
2. Every class is posted under its (coordinate, value) pairs. Pairs of sets that share at least
   ``THRESHOLD`` of the coordinates must share one of the ``COORDINATES - THRESHOLD + 1`` rarest
   of each (one global order, so the prefix principle holds); the longer posting lists beyond that prefix are
   skipped. Lists of one class, and lists that repeat the members of another, are dropped.
3. The members of each list meet in blocks of bounded size (a list beyond that is cut into
   hashed blocks, and every two blocks meet). Inside a block pair, collisions of the whole
   signature are counted; pairs above the threshold are confirmed on the full shingle sets. A
   search from set to set skips pairs that are already joined, and only a spanning star of each
   joined group leaves the task, never all pairs.
4. Components of these links by repeated label hooking, tables cut in the shared folder.

A pair of similarity 0.85 shares fewer than 10 of 24 coordinates with probability 2e-7, one of
0.80 with 7e-6; nothing else is approximate. Null or empty texts have no shingles and are linked with nothing. Rows
that repeat an id are one document; the row of the smallest set fingerprint speaks for it. Rows
with a null id are linked with nothing, too; each keeps a row of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.llm.store import fresh, only, stored
from churnloom.llm.text import SPACES, WordHasher, by_size, mix64, windows

WORDS = 5
COORDINATES = 24
THRESHOLD = 10
SIMILARITY = 85  # percent
#: percent from which a stage drops copies
STAGE_SIMILARITY = 80
#: shingles and members that one side of a block pair holds, about
BLOCK_SHINGLES = 1 << 20
BLOCK_MEMBERS = 2048

_SEEDS = mix64(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: pa.Array, hasher: WordHasher, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their numbers."""
    words, counts = hasher(texts)
    size = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    ends = np.cumsum(counts)
    whole = windows(words, n)
    total = np.cumsum(size)
    doc = np.repeat(np.arange(len(counts)), size)
    at = np.arange(len(doc)) - (total - size)[doc] + (ends - counts)[doc]
    short = (counts > 0) & (counts < n)
    if len(whole):
        values = whole[np.minimum(at, len(whole) - 1)]
    else:
        values = np.zeros(len(doc), np.uint64)
    for k in np.flatnonzero(short):
        own = words[ends[k] - counts[k] : ends[k]]
        values[total[k] - 1] = windows(own, len(own))[0] ^ np.uint64(len(own))
    for low, high in zip((total - size).tolist(), total.tolist(), strict=True):
        values[low:high].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new], np.bincount(doc[new], minlength=len(counts))


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash coordinates (documents x COORDINATES); rows of empty sets are meaningless."""
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    out = np.zeros((len(counts), COORDINATES), np.int32)
    if len(full):
        for k, seed in enumerate(_SEEDS):
            h = (values ^ seed) * seed
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            out[full, k] = (np.minimum.reduceat(h, starts) >> np.uint64(13)).astype(np.uint32).view(np.int32)
    return out


def fingerprints(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; equal for equal sets."""
    ends = np.cumsum(counts)
    out = []
    for salt in (0, 0xA5A5A5A5):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values ^ np.uint64(salt)))])
        out.append((sums[ends] - sums[ends - counts]).view(np.int64))
    return out[0], out[1]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher(SPACES)
    for batch in batches:
        for part in by_size(batch, "text"):
            values, counts = shingle_sets(part.column("text"), hasher)
            a, b = fingerprints(values, counts)
            sig = signatures(values, counts)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * COORDINATES, pa.int32()), pa.array(sig.reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts), pa.array(a), pa.array(b), flat], ["doc_id", "n_shingles", "fp_a", "fp_b", "sig"])


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set fingerprint (two halves) and signature of every row of (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(_features, "doc_id bigint, n_shingles bigint, fp_a bigint, fp_b bigint, sig array<int>")


def postings(classes: DataFrame) -> DataFrame:
    """(doc_id, fp_a, n_shingles, list) for lists of two classes or more within the rarest-first prefix."""
    every = classes.select("doc_id", F.posexplode("sig").alias("k", "value")).select("doc_id", F.xxhash64("k", "value").alias("list"))
    lengths = every.groupBy("list").agg(F.count("*").alias("length"))
    shared = lengths.where("length > 1")
    # lists of one member are the rarest of all: they only use up places of the prefix
    kept = every.join(shared, "list").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("length", "list"))).alias("lists"))
    prefix = F.lit(COORDINATES - THRESHOLD + 1) - (F.lit(COORDINATES) - F.size("lists"))
    rare = kept.where(prefix > 0).join(classes.select("doc_id", "fp_a", "n_shingles"), "doc_id")
    return rare.select("doc_id", "fp_a", "n_shingles", F.explode(F.slice("lists", 1, prefix)).alias("l")).select("doc_id", "fp_a", "n_shingles", F.col("l.list").alias("list"))


def meetings(posted: DataFrame) -> DataFrame:
    """(list, a, b, doc_id, fp_a): which blocks of which list each class goes to."""
    lists = posted.groupBy("list").agg(
        F.count("*").alias("members"),
        F.sum("n_shingles").alias("held"),
        F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("sum_a"),
        F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("sum_b"),
    )
    # of lists with the same members one is enough
    one = lists.where("members > 1").groupBy("members", "sum_a", "sum_b").agg(F.min(F.struct("list", "held")).alias("l"))
    blocks = F.ceil(F.greatest(F.col("l.held") / BLOCK_SHINGLES, F.col("members") / BLOCK_MEMBERS)).cast("int")
    one = one.select(F.col("l.list").alias("list"), blocks.alias("blocks"))
    mine = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("blocks")).cast("int")
    placed = posted.join(one, "list").select("list", "doc_id", "fp_a", mine.alias("mine"), "blocks")
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select("list", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "doc_id", "fp_a")


def join_sets(ids: np.ndarray, values: np.ndarray, counts: np.ndarray, sig: np.ndarray, similarity: int = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (smallest id, id) of the groups that links between these sets join.

    From each set in turn, all sets not reached yet are compared: first their sizes, then the
    collisions of their signatures, then the sets themselves.
    """
    n = len(ids)
    _, code = np.unique(values, return_inverse=True)
    starts = np.cumsum(counts) - counts
    marked = np.zeros(int(code.max(initial=-1)) + 1, bool)
    waiting = np.argsort(ids, kind="stable")
    left, right = [], []
    while len(waiting):
        root, waiting = waiting[0], waiting[1:]
        todo = [root]
        while todo and len(waiting):
            x = todo.pop()
            small, large = np.minimum(counts[waiting], counts[x]), np.maximum(counts[waiting], counts[x])
            near = 100 * small >= similarity * large
            near[near] = (sig[waiting[near]] == sig[x]).sum(1) >= THRESHOLD
            maybe = waiting[near]
            if not len(maybe):
                continue
            mine = code[starts[x] : starts[x] + counts[x]]
            marked[mine] = True
            size = counts[maybe]
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(starts[maybe], size)
            both = np.add.reduceat(marked[code[at]].astype(np.int64), ends - size)
            marked[mine] = False
            linked = 100 * both >= similarity * (size + counts[x] - both)
            reached = maybe[linked]
            todo += reached.tolist()
            left.append(np.full(len(reached), ids[root]))
            right.append(ids[reached])
            near[near] = linked
            waiting = waiting[~near]
    none = np.empty(0, np.int64)
    return np.concatenate(left) if left else none, np.concatenate(right) if right else none


def _links(similarity: int):
    """Links of block pairs; the rows of a block pair follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACES)

        def joined(held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
            ids = np.concatenate([h[0] for h in held])
            counts = np.concatenate([h[2] for h in held])
            values = np.concatenate([h[1] for h in held])
            return join_sets(ids, values, counts, signatures(values, counts), similarity)

        key, held, left, right = None, [], [], []
        for batch in batches:
            for part in by_size(batch, "text"):
                values, counts = shingle_sets(part.column("text"), hasher)
                # another text under the same id does not speak for it
                own = fingerprints(values, counts)[0] == part.column("fp_a").to_numpy()
                if not own.all():
                    part = part.filter(pa.array(own))
                    values, counts = values[np.repeat(own, counts)], counts[own]
                starts = np.concatenate([[0], np.cumsum(counts)])
                ids = part.column("doc_id").to_numpy()
                keys = np.stack([part.column(c).to_numpy() for c in ("list", "a", "b")], 1)
                cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
                for low, high in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                    now = tuple(keys[low])
                    if now != key and held:
                        x, y = joined(held)
                        left.append(x)
                        right.append(y)
                        held = []
                    key = now
                    held.append((ids[low:high], values[starts[low] : starts[high]], counts[low:high]))
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left), pa.int64()), pa.array(np.concatenate(right), pa.int64())], ["low", "high"])
                left, right = [], []
        if held:
            x, y = joined(held)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["low", "high"])

    return run


def links(docs: DataFrame, met: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Confirmed links (low, high) that join every group of similar classes."""
    # a shuffle at every size: what meets grows with the corpus
    with_text = met.join(docs.hint("merge"), "doc_id").select("list", "a", "b", "doc_id", "fp_a", "text")
    gathered = with_text.repartition("list", "a", "b").sortWithinPartitions("list", "a", "b")
    return gathered.mapInArrow(_links(similarity), "low bigint, high bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every id that has a link: the smallest id it can reach.

    Hooks neighbours to the smallest one they see, alternating between all neighbours and the
    smaller ones only; ends when the links are stars. Every round is a table in the shared folder.
    """
    edges = stored(edges.where("low <> high").select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")), "links")
    while True:
        both = edges.union(edges.select(F.col("high").alias("low"), F.col("low").alias("high")))
        # every node: its larger neighbours go to the smallest of the neighbourhood
        least = both.groupBy("low").agg(F.min("high").alias("m")).select(F.col("low").alias("node"), F.least("low", "m").alias("m"))
        large = both.where("high > low").join(least, F.col("low") == F.col("node")).select(F.col("m").alias("low"), "high").distinct()
        # every node: it and its smaller neighbours go to the smallest of them
        large = stored(large, "hooked")
        least = large.groupBy("high").agg(F.min("low").alias("m"), F.count("*").alias("n"))
        small = large.join(least.withColumnRenamed("high", "node"), F.col("high") == F.col("node"))
        small = small.select(F.col("m").alias("low"), F.when(F.col("low") == F.col("m"), F.col("high")).otherwise(F.col("low")).alias("high")).distinct()
        edges = stored(small, "links")
        roots = edges.select(F.col("low").alias("node")).distinct()
        twice = edges.groupBy("high").agg(F.count("*").alias("n")).where("n > 1").select(F.col("high").alias("node"))
        inner = edges.select(F.col("high").alias("node")).join(roots, "node", "left_semi").union(twice)
        if inner.isEmpty():
            return edges.select(F.col("high").alias("doc_id"), F.col("low").alias("component_id"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """One row per id: doc_id, n_shingles, component_id (smallest id reachable), kept.

    Sets are linked from ``similarity`` percent on; below 80 the signatures would miss links.
    """
    own = only(docs, **{doc_id: "doc_id", text: "text"}).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = features(own)
    best = F.min(F.struct("fp_a", "fp_b", "n_shingles", "sig")).alias("c")
    seen = stored(rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(best).select("doc_id", "c.*"), "features")
    full = seen.where("n_shingles > 0")
    members = full.select("doc_id", "fp_a", "fp_b", "n_shingles")
    first = F.min(F.struct("doc_id", "n_shingles", "sig")).alias("c")
    classes = stored(full.groupBy("fp_a", "fp_b").agg(first).select("fp_a", "fp_b", "c.*"), "classes")
    met = stored(meetings(postings(classes)), "meetings")
    reached = components(links(own, met, similarity)).withColumnRenamed("doc_id", "rep")
    of_class = members.join(classes.select("fp_a", "fp_b", F.col("doc_id").alias("rep")), ["fp_a", "fp_b"])
    ends = of_class.join(reached, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    alone = seen.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    unnamed = features(own.where("doc_id IS NULL")).select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    return ends.union(alone).union(unnamed).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """One row of each group of near-duplicates stays: that of the smallest id."""
    mark = fresh("gone")
    gone = near_duplicates(docs, doc_id=doc_id, text=text, similarity=similarity).where("NOT kept").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(gone, F.col(f"`{doc_id}`").cast("bigint") == F.col(mark), "left_anti")
