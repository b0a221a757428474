"""Mixing sources to target weights, with DataFrame operations only.

1. Sizes are words. Sources in code point order (null last) take the weights 3, 1, 2, repeating; their
   targets share ``EPOCHS`` times all words by weight, none above ``MOST`` times its own words,
   the excess reshared by weight (water-filling: the sources that overflow are those with the
   smallest cap per weight).
2. The documents of a source, in the order of (id bucket, id, ...), are one stream of words, cut
   into blocks of ``BLOCK`` words (the last one shorter). Offsets are prefix sums in two steps,
   inside ranges of ids, cut where a sketch of the ids says, and over the ranges of a source.
3. A source has as many slots as its target needs; its last slot is cut, so that the words taken
   are the target exactly (rounded down). A shard has ``SHARD_SLOTS`` places (the last one fewer).
   Every place draws its source with the chances of the quotas that remain: a Feistel permutation
   deals the slots of all sources to all places. The source counts of a shard are so a
   multinomial draw given what the quotas leave to it.
4. The places of a source, in the order of (shard, place), take its slots one after another: counts
   in cells of ``CELL`` places, prefix sums over the cells (``CELLS`` of them first, then over those), ranks inside them. Slot j is block P(j mod
   blocks) of pass j div blocks, P being a pseudorandom permutation of the block numbers for
   each source and pass: a Feistel network on the smallest rectangle a x b that holds the
   numbers, walked on until it falls inside. So a source is read through before it repeats.
5. Blocks are joined to slots by (source, block number), which is spread evenly however large a
   source is. The mix comes in the order of (shard, place), dealt to tasks by ranges of places.

Null texts have size 0. A source without words has target 0. Rows that repeat an
id are documents of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnloom.llm.store import fresh, only, stored
from churnloom.plans.ordered import cuts_below, running_totals

WEIGHTS = (3, 1, 2)
EPOCHS = 1.5
MOST = 2
BLOCK = 256
BUCKETS = 1024
SHARD_SLOTS = 4096
CELL = 256
#: cells that are added up together
CELLS = 4096
#: words that one task of the mix handles, about
TASK_WORDS = 1 << 24
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]"
#: steps of a walk; a walk leaves the rectangle's rim, which is under 1/sqrt(n) of it, long before
WALK = 40
ROUNDS = 3


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    own = only(docs, **{doc_id: "doc_id", source: "source", text: "text"})
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return own.select("doc_id", "source", size.alias("size"), *_keys(F.col("doc_id"), F.col("text"), F.col("source")))


def _keys(doc_id: Column, text: Column, source: Column) -> tuple[Column, Column]:
    """What tells rows apart: equal only where id, text and source are equal."""
    named = F.xxhash64(doc_id.isNull(), doc_id, source.isNull(), source, F.length(text))
    return named.alias("key"), F.xxhash64(text).alias("tie")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: float = EPOCHS, most: int = MOST) -> DataFrame:
    """(source, source_size, target): one row for each source, however many documents it has."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    order = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = F.sum("source_size").over(Window.partitionBy()) * epochs
    level = (everything - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    per = per.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    common = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(Window.partitionBy())
    share = F.least(F.col("weight") * common.getField("level"), F.col("cap"))
    return per.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(share).alias("target"))


def bucketed(sizes: DataFrame) -> DataFrame:
    """Documents with ``bucket``, monotone in the id: ``BUCKETS`` ranges of ids with about the same number of documents.

    The cuts come from a quantile sketch, so that sparse or hashed ids spread like dense ones; no result depends on where they lie.
    """
    cuts = F.array(*[F.lit(k / BUCKETS) for k in range(1, BUCKETS)])
    edges = sizes.agg(F.percentile_approx("doc_id", cuts, F.lit(8 * BUCKETS)).alias("edges")).scalar()
    at = cuts_below(F.col("edges"), F.col("doc_id"), BUCKETS - 1)
    # rows without an id come first
    spread = -1 - F.pmod("tie", F.lit(BUCKETS))
    bucket = F.when(F.col("doc_id").isNull(), spread).otherwise(at)
    return sizes.withColumn("edges", edges).withColumn("bucket", bucket.cast("bigint")).drop("edges")


def offsets(sizes: DataFrame) -> DataFrame:
    """Documents with ``start``, the words of their source before them."""
    rows = bucketed(sizes)
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    ahead = F.sum("held").over(Window.partitionBy("source").orderBy("bucket")) - F.col("held")
    totals = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"), ahead.alias("ahead"))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "tie", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("before", F.sum("size").over(inside) - F.col("size"))
    joined = rows.join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.select("doc_id", "source", "size", "key", "tie", (F.col("ahead") + F.col("before")).alias("start"))


def permuted(x: Column, n: Column, key: Column, back: bool = False) -> Column:
    """A pseudorandom permutation of 0 .. n-1, one for each key; ``back`` is its inverse."""
    a = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    b = F.ceil(n / a).cast("bigint")

    # half rounds, one side at a time: each step of the expression is small
    def half(s: Column, k: Column) -> Column:
        left, right = s["left"], s["right"]
        h = F.xxhash64(F.lit(SEED), k, key, F.when(k % 2 == 0, right).otherwise(left))
        h = -F.pmod(h, F.when(k % 2 == 0, a).otherwise(b)) if back else h
        return F.struct(F.when(k % 2 == 0, F.pmod(left + F.pmod(h, a), a)).otherwise(left).alias("left"), F.when(k % 2 == 1, F.pmod(right + F.pmod(h, b), b)).otherwise(right).alias("right"))

    def step(v: Column) -> Column:
        start = F.struct(F.floor(v / b).alias("left"), (v % b).alias("right"))
        return F.aggregate(F.array(*[F.lit(k) for k in (reversed(range(2 * ROUNDS)) if back else range(2 * ROUNDS))]), start, half, lambda s: s["left"] * b + s["right"])

    steps = F.array(*[F.lit(k) for k in range(WALK)])
    return F.aggregate(steps, step(x), lambda v, _: F.when(v < n, v).otherwise(step(v)))


def tasks_for(goals: DataFrame) -> int:
    """Tasks that work on the whole mix: as many as its words ask for, and not fewer than a shuffle has."""
    words = goals.agg(F.sum("target")).first()[0] or 0
    return max(int(goals.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(words / TASK_WORDS))


def slots(goals: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(source, block, words, turn, shard, slot, place, places): every place of the mix and what it takes.

    ``slot`` is the place in its shard, ``place`` the one in the mix of ``places``, ``turn`` the number of the
    slot in its source.
    """

    tasks = tasks_for(goals)

    def end_of(of_pass: Column) -> Column:
        return permuted(F.col("blocks") - 1, F.col("blocks"), F.xxhash64("source", of_pass))

    goals = goals.where("source_size > 0").select(
        "source", F.col("source_size").alias("total"), F.floor("target").alias("want"), F.ceil(F.col("source_size") / block).alias("blocks")
    )
    goals = goals.where("want > 0").withColumn("last", F.floor((F.col("want") - 1) / F.col("total"))).withColumn("missing", F.col("blocks") * block - F.col("total"))
    # where the last block, which is shorter, stands in the order of each pass
    goals = goals.withColumn("ends", F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("last")), end_of))
    rest = F.col("want") - F.col("last") * F.col("total")
    few = F.ceil(rest / block)
    few = F.when(few > F.element_at("ends", (F.col("last") + 1).cast("int")), F.ceil((rest + F.col("missing")) / block)).otherwise(few)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    goals = goals.withColumn("own", F.col("last") * F.col("blocks") + few).withColumn("no", F.row_number().over(by_name))
    goals = goals.withColumn("base", F.sum("own").over(by_name) - F.col("own")).withColumn("places", F.sum("own").over(Window.partitionBy()))
    # ranges of at most 4096 numbers first, so that no row unfolds into a whole source
    runs = goals.select("no", "base", "own", "places", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("own") - 1) / 4096))).alias("run"))
    # few rows that become many: they say how many tasks, which their size would not ask for
    every = runs.repartition(tasks, "no", "run").withColumn("j", F.explode(F.sequence(F.col("run") * 4096, F.least((F.col("run") + 1) * 4096, "own") - 1)))
    drawn = stored(every.select("no", permuted(F.col("base") + F.col("j"), F.col("places"), F.lit(SEED).cast("bigint")).alias("place")), "places")
    drawn = drawn.withColumn("cell", F.floor(F.col("place") / CELL))
    counts = drawn.groupBy("cell", "no").agg(F.count("*").alias("n"))
    counts = running_totals(counts, ["no"], "cell", ["n"], F.floor(F.col("cell") / CELLS))
    counts = counts.select("cell", "no", (F.col("run_n") - F.col("n")).alias("ahead")).join(goals, "no")
    rank = F.row_number().over(Window.partitionBy("cell", "no").orderBy("place")) - 1
    met = drawn.withColumn("rank", rank).join(counts, ["cell", "no"]).withColumn("turn", F.col("ahead") + F.col("rank"))
    met = met.withColumn("pass", F.floor(F.col("turn") / F.col("blocks"))).withColumn("at", F.col("turn") % F.col("blocks"))
    met = met.withColumn("end", F.element_at("ends", (F.col("pass") + 1).cast("int")))
    taken = F.col("pass") * F.col("total") + F.col("at") * block - F.when(F.col("at") > F.col("end"), F.col("missing")).otherwise(0)
    words = F.least(block - F.when(F.col("at") == F.col("end"), F.col("missing")).otherwise(0), F.col("want") - taken)
    of_place = permuted(F.col("at"), F.col("blocks"), F.xxhash64("source", "pass"), back=True)
    shard, slot = F.floor(F.col("place") / shard_slots), F.col("place") % shard_slots
    return met.select("source", of_place.alias("block"), words.alias("words"), "turn", shard.alias("shard"), slot.alias("slot"), "place", "places")


def placed(sizes: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, **options) -> tuple[DataFrame, DataFrame]:
    """The slots of the mix with the part of each document they take, and the targets.

    Parts: (source, shard, slot, place, places, key, tie, start, low, high), words low .. high - 1 of a document.
    """
    goals = stored(targets(sizes, **options), "targets")
    docs = offsets(sizes)
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = docs.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    pieces = pieces.withColumn("of", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull()).drop("source")
    cut = slots(goals, block, shard_slots).withColumn("of", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull())
    # the planner takes the slots for as small as the sources they come from: shuffle them
    met = cut.hint("merge").join(pieces, ["of", "none", "block"])
    low = F.greatest(F.col("block") * block, "start") - F.col("start")
    high = F.least(F.col("block") * block + F.col("words"), F.col("start") + F.col("size")) - F.col("start")
    parts = met.select("source", "shard", "slot", "place", "places", "key", "tie", "start", low.alias("low"), high.alias("high")).where("high > low")
    return parts, goals


def taken_words(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    sizes = stored(sized(docs, doc_id, text, source), "sizes")
    parts, goals = placed(sizes, **options)
    # the place in the stream tells equal rows apart
    sums = parts.groupBy(F.coalesce("source", F.lit("")).alias("of"), F.col("source").isNull().alias("none"), "start").agg(F.sum(F.col("high") - F.col("low")).alias("got"))
    own = offsets(sizes).withColumn("of", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull())
    full = own.where("size > 0").join(sums, ["of", "none", "start"], "left").select("doc_id", "source", "size", F.coalesce("got", F.lit(0)).alias("taken"))
    empty = own.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("bigint").alias("taken"))
    goals = goals.select(F.col("source").alias("s"), "source_size", "target")
    every = full.union(empty)
    return every.join(goals, every["source"].eqNullSafe(goals["s"])).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", n_chars: str = "n_chars", shard: str = "shard", slot: str = "slot", **options) -> DataFrame:
    """The mixed corpus with the shard and the slot in it of every row, in their order.

    One row for each part of a document in a slot, the parts of a slot in the order of the source:
    runs of whole words with the white space after each; the parts of a document that
    a slot takes in full put together again give its text. ``n_chars`` is counted anew where the column exists.
    """
    parts, goals = placed(stored(sized(docs, doc_id, text, source), "sizes"), **options)
    key, tie, held, words, place, start, task = (fresh(x) for x in ("key", "tie", "parts", "words", "place", "start", "task"))
    tasks = tasks_for(goals)
    of_task = F.floor(F.col("place") * tasks / F.col("places")).cast("int")
    gathered = parts.groupBy(F.col("key").alias(key), F.col("tie").alias(tie)).agg(F.collect_list(F.struct("low", "high", "shard", "slot", "place", "start", of_task.alias("task"))).alias(held))
    own = dict(zip((key, tie), _keys(*[F.col(f"`{c}`") for c in (doc_id, text, source)]), strict=True))
    # equal rows have their parts in common: one of them reads all
    once = docs.withColumns(own).dropDuplicates([key, tie])
    cut = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(rf"(?:^{GAP}*)?{WORD}{GAP}*"), F.lit(0))
    joined = once.join(gathered, [key, tie]).withColumn(words, cut).withColumn(held, F.explode(held))
    low, high = F.col(f"{held}.low").cast("int"), F.col(f"{held}.high").cast("int")
    piece = F.array_join(F.slice(words, low + 1, high - low), "")
    columns = [piece.alias(c) if c == text else F.length(piece).cast("bigint").alias(c) if c == n_chars else F.col(f"`{c}`") for c in docs.columns]
    order = {shard: "shard", slot: "slot", place: "place", start: "start", task: "task"}
    rows = joined.select(*columns, *[F.col(f"{held}.{c}").alias(name) for name, c in order.items()])
    # places are dealt evenly, so equal ranges of them need no sample
    return rows.repartitionById(tasks, task).sortWithinPartitions(place, start).drop(place, start, task)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs`` for every row of :func:`mixed`, in the same order."""
    shard, slot = fresh("shard"), fresh("slot")
    return mixed(docs, shard=shard, slot=slot, **options).drop(shard, slot)
