"""Benchmark decontamination with suffix arrays over the training texts.

Every task cuts its documents into shards of at most ``SHARD`` words and sorts all suffixes of a
shard (by word hashes, prefix doubling). Benchmark suffixes are then located by binary search, one word deeper at a
time: the depth at which a range empties is the length of the longest verbatim match, the last range holds the
places. Hits need no more than the words of a window, so that is how deep the search goes and how far shards
overlap; each distinct window is searched once. Where ``matches`` are wanted, all suffixes are searched, ``DEPTH`` words
deep, and matches that reach that depth or the end of a shard are followed word by word in the document
itself, so neither items nor documents are bounded in length.

Documents are never shuffled. Items of equal text are one. The benchmark is cut into blocks of about ``BLOCK_BYTES`` by
hash on Spark; one block is collected and broadcast at a time, and between blocks the documents with the
columns found so far are written to the shared folder.

Defined results: a null text has no words and no hits. An item without words is ignored; an item
shorter than the window counts as one window. An item with a null id marks words but is not
listed. Repeated rows are judged one by one, repeated item ids listed once. Empty tables give no rows, or no hits. Very
long texts and items are searched whole. Columns of the input keep their names; those that
this operator adds replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnloom.llm.store import fresh, only, stored
from churnloom.llm.text import NOT_LETTERS, WordHasher, by_size, windows

WINDOW = 10
#: words of a shard; positions and ranks of a shard fit in 20 bits
SHARD = 1 << 20
#: words that the search for longest matches goes down; longer ones are followed in the text
DEPTH = 256
#: words compared at a time there, and places looked at together
FOLLOWED = 64
TOGETHER = 1 << 20
#: text bytes of the benchmark held at once
BLOCK_BYTES = 16 << 20
#: text bytes of one round of shards
SLICE = 3 << 20
_KEY_BITS = np.uint64(20)
_LOW = np.uint64(SHARD - 1)

MATCHES = "array<struct<item_id:bigint,item_pos:int,doc_pos:bigint,length:int>>"


@dataclass
class Block:
    """Benchmark suffixes of one block, as word hashes."""

    words: np.ndarray  # all words of the items, one after another
    suffix: np.ndarray  # where each suffix begins in words
    left: np.ndarray  # words from there to the end of its item
    depth: np.ndarray  # words of the window that begins there, 0: none
    window: np.ndarray  # number of that window, equal windows have one number
    item: np.ndarray  # item of each suffix
    place: np.ndarray  # its place in the item
    ids: list  # ids of the items, a list for each distinct text


def make_block(rows: list[tuple], window: int) -> Block:
    texts = pa.array([r[1] for r in rows], pa.large_string())
    words, counts = WordHasher(NOT_LETTERS)(texts)
    ends = np.cumsum(counts)
    item = np.repeat(np.arange(len(rows)), counts)
    suffix = np.arange(len(words))
    left = ends[item] - suffix
    size = np.minimum(window, counts)[item]
    depth = np.where(left >= size, size, 0)
    first = suffix == (ends - counts)[item]
    depth[(size < window) & ~first] = 0
    key = np.zeros(len(words), np.uint64)
    whole = windows(words, window)
    key[: len(whole)] = whole
    for k in np.flatnonzero((depth > 0) & (depth < window)):
        key[k] = windows(words[k : k + depth[k]], int(depth[k]))[0] ^ np.uint64(depth[k])
    _, number = np.unique(key, return_inverse=True)
    return Block(words, suffix, left, depth, number, item, suffix - (ends - counts)[item], [r[0] for r in rows])


def suffix_array(keys: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first ``depth`` keys at least (keys below 2^44)."""
    n = len(keys)
    places = np.arange(n, dtype=np.uint64)
    packed = np.sort((keys << _KEY_BITS) | places)
    order = (packed & _LOW).astype(np.int64)
    head = packed >> _KEY_BITS
    new = np.empty(n, bool)
    new[:1] = True
    np.not_equal(head[1:], head[:-1], out=new[1:])
    rank = np.empty(n + 1, np.uint64)
    rank[n] = 0
    known = 1
    while True:
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = first.astype(np.uint64) + np.uint64(1)
        last = np.append(new[1:], True)
        open_ = np.flatnonzero(~(new & last))
        if known >= depth or not len(open_):
            return order
        at = order[open_]
        follows = rank[np.minimum(at + known, n)]
        packed = np.sort((first[open_].astype(np.uint64) << np.uint64(42)) | (follows << np.uint64(21)) | at.astype(np.uint64))
        order[open_] = (packed & np.uint64((1 << 21) - 1)).astype(np.int64)
        head = packed >> np.uint64(21)
        new[open_[1:]] = head[1:] != head[:-1]
        new[open_[:1]] = True
        known *= 2


def _bound(keys: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, want: np.ndarray, d: int, right: bool) -> np.ndarray:
    """Binary search in each range for the first suffix whose d-th key reaches (or passes) want."""
    low, high = low.copy(), high.copy()
    while True:
        busy = np.flatnonzero(low < high)
        if not len(busy):
            return low
        mid = (low[busy] + high[busy]) // 2
        place = order[mid] + d
        seen = np.where(place < len(keys), keys[np.minimum(place, len(keys) - 1)], 0)
        go = seen <= want[busy] if right else seen < want[busy]
        low[busy[go]] = mid[go] + 1
        high[busy[~go]] = mid[~go]


def search(words: np.ndarray, block: Block, wanted: np.ndarray, longest: int) -> tuple[np.ndarray, ...]:
    """Longest match of the ``wanted`` suffixes in one shard, up to ``longest`` words.

    Returns, for each suffix of the block, the match length and its range in the suffix array,
    the range at window depth, and the suffix array. Word 0 ends a document and matches nothing.
    """
    keys = words >> _KEY_BITS
    query = block.words >> _KEY_BITS
    order = suffix_array(keys, longest)
    q = len(block.suffix)
    length = np.zeros(q, np.int64)
    low, high = np.zeros(q, np.int64), np.full(q, len(keys))
    range_at = np.zeros((q, 2), np.int64)
    window_at = np.zeros((q, 2), np.int64)
    busy = wanted
    sorted_first = keys[order]
    for d in range(longest):
        busy = busy[block.left[busy] > d]
        if not len(busy):
            break
        want = query[block.suffix[busy] + d]
        if d == 0:
            a, b = np.searchsorted(sorted_first, want, "left"), np.searchsorted(sorted_first, want, "right")
        else:
            a = _bound(keys, order, low[busy], high[busy], want, d, False)
            b = _bound(keys, order, a, high[busy], want, d, True)
        found = a < b
        busy, a, b = busy[found], a[found], b[found]
        low[busy], high[busy] = a, b
        length[busy] = d + 1
        range_at[busy, 0], range_at[busy, 1] = a, b
        full = busy[block.depth[busy] == d + 1]
        window_at[full, 0], window_at[full, 1] = low[full], high[full]
    return length, range_at, window_at, order


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and members of the ranges [low, high)."""
    n = high - low
    row = np.repeat(np.arange(len(low)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def shards(words: np.ndarray, counts: np.ndarray, overlap: int, size: int = SHARD) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Shards of word hashes with a 0 after each piece, and the document and place of each word.

    A document longer than a shard is cut into pieces that share ``overlap`` words, so no match
    is lost at a cut.
    """
    room = size - 1
    parts, docs, places, used = [], [], [], 0
    ends = np.cumsum(counts)
    for doc in np.flatnonzero(counts):
        start = int(ends[doc] - counts[doc])
        at, n = 0, int(counts[doc])
        while True:
            take = min(n - at, room)
            if used + take + 1 > size:
                yield np.concatenate(parts), np.concatenate(docs), np.concatenate(places)
                parts, docs, places, used = [], [], [], 0
            parts += [words[start + at : start + at + take], np.zeros(1, np.uint64)]
            docs.append(np.full(take + 1, doc))
            places.append(np.arange(at, at + take + 1))
            used += take + 1
            if at + take >= n:
                break
            at += take - overlap
    if used:
        yield np.concatenate(parts), np.concatenate(docs), np.concatenate(places)


def _mark(words: np.ndarray, counts: np.ndarray, block: Block, window: int, with_matches: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hit words (document, place), window occurrences (document, window) and match records (document, suffix, place, length)."""
    hits, seen, records = [np.empty((0, 2), np.int64)], [np.empty((0, 2), np.int64)], [np.empty((0, 4), np.int64)]
    used = np.flatnonzero(block.depth)
    one = np.zeros(len(block.suffix), bool)  # one suffix for each distinct window
    one[used[np.unique(block.window[used], return_index=True)[1]]] = True
    wanted = used if with_matches else np.flatnonzero(one)
    longest = min(DEPTH, int(block.left.max(initial=1))) if with_matches else window
    begin = np.cumsum(counts) - counts
    for shard, doc, place in shards(words, counts, window - 1, max(SHARD // 2, 2 * window)):
        length, range_at, window_at, order = search(shard, block, wanted, max(longest, window))
        pick = np.flatnonzero(one & (window_at[:, 1] > window_at[:, 0]))
        row, at = _spread(window_at[pick, 0], window_at[pick, 1])
        begins, query = order[at], pick[row]
        step, k = _spread(np.zeros(len(begins), np.int64), block.depth[query])
        hit = begins[step] + k
        # the keys leave out the low bits of a hash: compare whole ones
        same = shard[hit] == block.words[block.suffix[query[step]] + k]
        good = np.ones(len(begins), bool)
        good[step[~same]] = False
        hit = np.unique(hit[good[step]])
        hits.append(np.stack([doc[hit], place[hit]], 1))
        seen.append(np.unique(np.stack([doc[begins[good]], block.window[query[good]]], 1), axis=0))
        if not with_matches:
            continue
        pick = np.flatnonzero((length >= block.depth) & (block.depth > 0) & (range_at[:, 1] > range_at[:, 0]))
        for some in _portions(pick, range_at[pick, 1] - range_at[pick, 0]):
            row, at = _spread(range_at[some, 0], range_at[some, 1])
            begins, query = order[at], some[row]
            # only those that do not merely continue a match from the word before, in the whole document
            where = begin[doc[begins]] + place[begins]
            goes_on = (place[begins] > 0) & (block.place[query] > 0)
            goes_on &= words[np.maximum(where - 1, 0)] == block.words[block.suffix[query] - 1]
            begins, query, where = begins[~goes_on], query[~goes_on], where[~goes_on]
            size = _followed(words, where, begin[doc[begins]] + counts[doc[begins]], block, query)
            whole = size >= block.depth[query]
            records.append(np.stack([doc[begins], query, place[begins], size], 1)[whole])
    return tuple(np.unique(np.concatenate(x), axis=0) for x in (hits, seen, records))


def _portions(rows: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in runs of about TOGETHER places."""
    if len(rows):
        yield from np.split(rows, np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // TOGETHER)) + 1)


def _followed(words: np.ndarray, where: np.ndarray, ends: np.ndarray, block: Block, query: np.ndarray) -> np.ndarray:
    """How many words from ``where`` on (up to the document's end) agree with each item from its suffix on."""
    room = np.minimum(ends - where, block.left[query])
    size, busy = np.zeros(len(where), np.int64), np.arange(len(where))
    while len(busy):
        at = size[busy, None] + np.arange(FOLLOWED)
        inside = at < room[busy, None]
        mine = words[np.minimum(where[busy, None] + at, len(words) - 1)]
        theirs = block.words[np.minimum(block.suffix[query[busy], None] + at, len(block.words) - 1)]
        run = np.cumprod(inside & (mine == theirs), axis=1).sum(1)
        size[busy] += run
        busy = busy[run == FOLLOWED]
    return size


def _pass(block, text: str, found: str, window: int, with_matches: bool):
    """One pass over Arrow batches against one broadcast block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_LETTERS)
        data: Block = block.value
        by_window: dict[int, set] = {}
        for k in np.flatnonzero(data.depth):
            by_window.setdefault(int(data.window[k]), set()).update(data.ids[data.item[k]])
        for batch in batches:
            for part in by_size(batch, text, SLICE):
                words, counts = hasher(part.column(text))
                hits, seen, records = _mark(words, counts, data, window, with_matches)
                rows = part.column(found).to_pylist()
                out = [{"n_words": int(n), "hit": [], "items": [], "matches": []} if old is None else old for n, old in zip(counts, rows, strict=True)]
                for doc in np.unique(hits[:, 0]):
                    mine = hits[hits[:, 0] == doc, 1]
                    out[doc]["hit"] = np.union1d(np.array(out[doc]["hit"], np.int64), mine).tolist()
                for doc, w in seen.tolist():
                    out[doc]["items"] = sorted(set(out[doc]["items"]) | set(by_window.get(w, ())))
                for doc, k, at, n in records.tolist():
                    names = data.ids[data.item[k]] or [None]
                    out[doc]["matches"] += [{"item_id": name, "item_pos": int(data.place[k]), "doc_pos": at, "length": n} for name in names]
                column = pa.array(out, part.schema.field(found).type)
                yield part.set_column(part.schema.get_field_index(found), part.schema.field(found), column)

    return run


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """Distinct texts with their ids, in blocks of about ``limit`` bytes (a longer item is in a block as it is)."""
    items = benchmark.where(F.length("text") > 0).groupBy("text").agg(F.collect_set("item_id").alias("ids"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // limit))
    if count > 1:
        items = stored(items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(count)).cast("int")), "benchmark")
    for k in range(count):
        mine = items.where(F.col("block") == k) if count > 1 else items
        yield [(sorted(r.ids), r.text) for r in mine.select("ids", "text").collect()]


def _matched(
    docs: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, window: int, block_bytes: int, with_matches: bool
) -> tuple[DataFrame, str]:
    spark = docs.sparkSession
    found = fresh("found")
    kind = f"struct<n_words:bigint,hit:array<bigint>,items:array<bigint>,matches:{MATCHES}>"
    out = docs.withColumn(found, F.lit(None).cast(kind))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema])
    before = None
    for rows in _blocks(only(benchmark, **{item_id: "item_id", item_text: "text"}), block_bytes):
        if before is not None:  # hold one block at a time
            out = stored(out, "searched")
            before.unpersist()
        before = spark.sparkContext.broadcast(make_block(rows, window))
        out = out.mapInArrow(_pass(before, text, found, window, with_matches), schema)
    return out, found


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    matches: bool = True,
) -> DataFrame:
    """All documents with ``n_words``, ``hit_words``, ``items`` and, if wanted, ``matches``.

    ``hit_words`` are the word positions inside an occurrence of any window, ``items`` the ids of
    items with such a window, ``matches`` the longest verbatim matches of item suffixes with
    their locations (only where they do not continue a match one word earlier).
    """
    out, found = _matched(docs, benchmark, text, item_id, item_text, window, block_bytes, matches)
    added = {"n_words": "n_words", "hit_words": "hit", "items": "items"} | ({"matches": "matches"} if matches else {})
    return out.withColumns({new: F.col(f"{found}.{old}") for new, old in added.items()}).drop(found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without any hit, with the columns they came with."""
    out, found = _matched(docs, benchmark, text, item_id, item_text, window, block_bytes, False)
    return out.where(F.size(f"{found}.hit") == 0).drop(found)
