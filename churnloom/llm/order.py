"""Token sequences in training order, as fixed-stride binary shards.

1. Texts become token ids, each text followed by the end id. Every scan task packs its texts one
   after another into sequences of ``LENGTH`` ids (its last one is filled up with the end id) and
   stores them compressed in the shared folder. Sequence number i counts over the tasks.
2. Sequence i of n goes to the global slot F(i): a keyed Feistel network on a square of at
   least n numbers, walked on until it falls below n, so every slot from 0 to n - 1 is taken once.
3. Slots are range-partitioned; shard s is one file with the slots from s * ``SHARD`` on, in order. A
   record is LENGTH little-endian 2-byte ids and a line feed, so every record has the same
   stride: slot k is at byte (k mod SHARD) * (2 * LENGTH + 1) of shard k div SHARD, and a reader
   resumes at any slot without an index.

Shards go through Spark's text writer: a lost executor's files are written again, only whole
files are committed, and any file system that Spark knows will do. Null and empty texts give the
end id alone. Every row counts, also rows that repeat an id; the numbering follows the stored
sequences, so a reader always agrees with the shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnloom.llm.store import only, stored
from churnloom.llm.text import by_size, give_back
from churnloom.llm.tokens import SLICE, VOCABULARY, tokenizer
from churnloom.session import scratch_path

LENGTH = 4096
SHARD = 512
KEY = 7
ROUNDS = 4
#: the square is below 8 n, so a step of the walk leaves with a chance of an eighth at least: 400 steps never fall short
WALK = 400

PACKED = "part int, idx bigint, n_tokens int, doc_ids array<bigint>, doc_at array<int>, ids binary"


def feistel(x: Column, n: Column, key: int = KEY) -> Column:
    """Keyed permutation of 0 .. n-1, by cycle-walking."""
    half = F.ceil(F.log2(F.greatest(n, F.lit(2)).cast("double")) / 2).cast("int")
    side = F.pow(F.lit(2.0), half).cast("bigint")

    def step(v: Column) -> Column:
        left, right = F.floor(v / side), v % side
        for r in range(0, ROUNDS, 2):
            left = (left + F.pmod(F.xxhash64(F.lit(key), F.lit(r), right), side)) % side
            right = (right + F.pmod(F.xxhash64(F.lit(key), F.lit(r + 1), left), side)) % side
        return left * side + right

    first = step(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda v, _: F.when(v < n, v).otherwise(step(v)))


def _pack(length: int, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tokens = tokenizer(vocabulary, True)
        end = next(iter(tokens.special.values()))
        if len(tokens.merges.result) + 512 >= 1 << 16:
            raise ValueError("ids of this vocabulary do not fit in two bytes")
        squeeze = zstandard.ZstdCompressor(level=6)
        part, made = TaskContext.get().partitionId(), 0
        ids, docs, begins = np.empty(0, np.uint16), np.empty(0, np.int64), np.empty(0, np.int64)
        null = np.empty(0, bool)

        def out(stream: np.ndarray, names: np.ndarray, none: np.ndarray, at: np.ndarray, full: int) -> pa.RecordBatch:
            """The first ``full`` tokens of a stream as sequences; at: where its documents begin."""
            rows = -(-full // length)
            padded = np.full(rows * length, end, np.uint16)
            padded[:full] = stream[:full]
            cuts = np.arange(rows) * length
            first = np.maximum(np.searchsorted(at, cuts, side="right") - 1, 0)
            last = np.searchsorted(at, np.minimum(cuts + length, full), side="left")
            held = [np.arange(a, b) for a, b in zip(first, last, strict=True)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows, part), pa.int32()),
                    pa.array(np.arange(made, made + rows)),
                    pa.array(np.minimum(full - cuts, length), pa.int32()),
                    pa.array([pa.array(names[h], pa.int64(), mask=none[h]).to_pylist() for h in held], pa.list_(pa.int64())),
                    pa.array([np.maximum(at[h] - c, 0).tolist() for h, c in zip(held, cuts, strict=True)], pa.list_(pa.int32())),
                    pa.array([squeeze.compress(padded[c : c + length].tobytes()) for c in cuts], pa.binary()),
                ],
                ["part", "idx", "n_tokens", "doc_ids", "doc_at", "ids"],
            )

        for batch in batches:
            for piece in by_size(batch, "text", SLICE):
                totals, flat = tokens(piece.column("text"))
                spot = np.cumsum(totals + 1)
                new = np.full(int(spot[-1]), end, np.uint16)
                inside = np.ones(len(new), bool)
                inside[spot - 1] = False
                new[inside] = flat
                begins = np.concatenate([begins, len(ids) + spot - totals - 1])
                names = piece.column("doc_id")
                docs = np.concatenate([docs, names.fill_null(0).to_numpy(zero_copy_only=False)])
                null = np.concatenate([null, names.is_null().to_numpy(zero_copy_only=False)])
                ids = np.concatenate([ids, new])
                full = len(ids) // length * length
                if full:
                    yield out(ids, docs, null, begins, full)
                    made += full // length
                    stay = max(int(np.searchsorted(begins, full, side="right")) - 1, 0)
                    ids, docs, null, begins = ids[full:], docs[stay:], null[stay:], begins[stay:] - full
                    if not len(ids):
                        docs, null, begins = docs[:0], null[:0], begins[:0]
        if len(ids):
            yield out(ids, docs, null, begins, len(ids))

    return run


def sequences(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, shard: int = SHARD, vocabulary: str = VOCABULARY, key: int = KEY) -> DataFrame:
    """Stored sequences with their slot and shard: (slot, shard, seq, n_tokens, doc_ids, doc_at, ids).

    ``doc_ids`` are the documents in the sequence, ``doc_at`` where each begins in it (0 also for
    one that began earlier); ``ids`` is compressed.
    """
    own = only(docs, **{doc_id: "doc_id", text: "text"}).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    packed = stored(own.mapInArrow(_pack(length, vocabulary), PACKED), "sequences")
    # one row for each scan task
    counts = packed.groupBy("part").agg(F.count("*").alias("held"))
    ahead = F.sum("held").over(Window.orderBy("part")) - F.col("held")
    counts = counts.select("part", ahead.alias("ahead"), F.sum("held").over(Window.partitionBy()).alias("n"))
    # a few numbers for each scan task: small enough for every executor however large the corpus is
    numbered = packed.join(F.broadcast(counts), "part").withColumn("seq", F.col("ahead") + F.col("idx"))
    slot = feistel(F.col("seq"), F.col("n"), key)
    return numbered.withColumn("slot", slot).withColumn("shard", F.floor(F.col("slot") / shard)).select("slot", "shard", "seq", "n_tokens", "doc_ids", "doc_at", "ids")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        # a few records at a time: they are many times the size of their compressed form
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            raw = [expand.decompress(x) for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("shard"), part.column("slot"), pa.array(raw, pa.binary())], ["shard", "slot", "ids"])
        give_back()


def write_shards(ordered: DataFrame, path: str) -> None:
    """One file of records for each shard, in folders shard=0, shard=1, ..."""
    dealt = ordered.select("shard", "slot", "ids").repartitionByRange("shard")
    records = dealt.mapInArrow(_unpacked, "shard bigint, slot bigint, ids binary")
    rows = records.sortWithinPartitions("shard", "slot").select(F.col("ids").cast("string").alias("value"), "shard")
    rows.write.partitionBy("shard").option("lineSep", "\n").text(path)


def read_shards(spark: SparkSession, path: str, *, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(slot, shard, offset, record_sha256) of every record as it stands in the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.where(F.col("path").endswith(".txt"))
    stride = 2 * length + 1
    number = F.regexp_extract("path", r"shard=(\d+)/", 1).cast("bigint")
    numbers = F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("length") / stride) - 1)

    def records(content: Column) -> Column:
        digest = lambda k: F.sha2(F.substring(content, (k * stride + 1).cast("int"), F.lit(2 * length)), 256)
        return F.transform(numbers, lambda k: F.struct(k.alias("k"), digest(k).alias("sha")))

    # the outer array of one hands the file's bytes to all records; read from the row, each would copy the file
    record = F.flatten(F.transform(F.array("content"), records))
    one = files.where(F.col("length") >= stride).select(number.alias("shard"), F.explode(record).alias("r"))
    return one.select((F.col("shard") * shard + F.col("r.k")).alias("slot"), "shard", (F.col("r.k") * stride).alias("offset"), F.col("r.sha").alias("record_sha256"))


def materialise(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write all shards; one row for each sequence as read back from them.

    (slot, shard, offset, seq, n_tokens, doc_ids, doc_at, record_sha256)
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    ordered = sequences(docs, **options)
    write_shards(ordered, path)
    back = read_shards(spark, path, length=options.get("length", LENGTH), shard=options.get("shard", SHARD))
    return back.join(ordered.select("slot", "seq", "n_tokens", "doc_ids", "doc_at"), "slot")
