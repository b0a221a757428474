"""Spelling variants: words of the vocabulary that one edit separates, found in FM-indexes.

1. Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; their occurrences are
   counted over all texts (``word_counts``). Arrow batches are cut on bytes; counts of a slice are added up
   before they are shuffled.
2. One edit leaves the first or the second half of a word untouched. So a word asks twice: for words
   that begin with its first half, and for words that end with its second one. Words are dealt to
   buckets by these halves: each word is posted under the halves that a word of its length, one
   less or one more can ask for, and asks in the bucket of its own.
3. A bucket's words form one delimited text, ``$w1$w2$...$``, read forwards for first halves and backwards
   for second ones: the two directions of a bidirectional index. Its suffixes are sorted and
   its Burrows-Wheeler transform is indexed. Every pattern begins at a delimiter, so a search
   scheme extends in one direction only: the delimiter and the half exactly, then across the
   other half with exactly one inserted, deleted or replaced code point, then the delimiter. A
   state is an interval of suffix ranks; all patterns of a bucket take their steps together.
4. The near word of largest count is a word's form if it is frequent enough; chains of forms are
   followed by pointer jumping.

A bucket holds about ``BUCKET_WORDS`` words. A half with more than a quarter of that is cut into parts by
the hash of the word, and its askers ask in every part; nothing is capped.

Null and empty texts have no words. Rows that repeat a document count each time. A null id is the empty
text. Ties go to the smaller word in code-point order. Other columns play no part, whatever their names.
Texts are cut as a whole, however long; a long word is a pattern of as many steps. Empty tables give no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom.llm.store import only, stored
from churnloom.llm.text import by_size, text_bytes

SHORTEST = 6
RAREST = 5
#: a form is at least this many times as frequent
TIMES = 5
BUCKET_WORDS = 1 << 15
#: patterns that are searched together
TOGETHER = 1 << 13
SLICE = 1 << 22
#: bytes up to which checksums are worked out for all runs at once
SHORT_RUN = 48

#: register of a CRC-32 after one byte, from register 0
_STEP = np.array([zlib.crc32(bytes([k]), 0xFFFFFFFF) ^ 0xFFFFFFFF for k in range(256)], np.uint32)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True


# ---- the vocabulary --------------------------------------------------------------------------


def word_counts(docs: DataFrame, drop_every: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least SHORTEST code points with at least RAREST occurrences.

    With ``drop_every``, typing errors are laid in first: where it divides the CRC-32 of
    ``<doc_id>:<word>``, the word loses its code point number CRC-32 modulo its length.
    """
    own = only(docs, **{doc_id: "doc_id", text: "text"}).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, "text", SLICE):
                words, n = _counted(part.column("doc_id"), part.column("text"), drop_every)
                yield pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    counted = own.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= RAREST)


def _counted(ids: pa.Array, texts: pa.Array, drop_every: int | None) -> tuple[pa.Array, pa.Array]:
    """Distinct words of a slice and how often each occurs."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    first = data == 0xC3  # U+00C0 to U+00FF are C3 and one more byte
    letter = _LETTER[data] | first
    letter[1:] |= first[:-1]
    edge = np.ones(len(data) + 1, bool)
    np.not_equal(letter[1:], letter[:-1], out=edge[1:-1])
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    runs = letter[cuts[:-1]]
    starts, ends = cuts[:-1][runs], cuts[1:][runs]
    wide = np.concatenate([[0], np.cumsum(first)])
    points = ends - starts - (wide[ends] - wide[starts])
    long = points >= SHORTEST
    starts, ends, points = starts[long], ends[long], points[long]
    shorter: dict[str, int] = {}
    if drop_every:
        doc = np.searchsorted(offsets, starts, side="right") - 1
        seeds = np.array([zlib.crc32(f"{name}:".encode()) for name in ids.to_pylist()], np.uint32)
        sums = _checksums(data, starts, ends, seeds[doc])
        hit = sums % np.uint32(drop_every) == 0
        for a, b, n, h in zip(starts[hit].tolist(), ends[hit].tolist(), points[hit].tolist(), sums[hit].tolist(), strict=True):
            word, k = data[a:b].tobytes().decode(), h % n
            if n > SHORTEST:
                word = word[:k] + word[k + 1 :]
                shorter[word] = shorter.get(word, 0) + 1
        starts, ends = starts[~hit], ends[~hit]
    tally = pc.value_counts(pa.concat_arrays([_gathered(data, starts, ends), _repeated(shorter)]))
    return tally.field(0), tally.field(1)


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of bytes, each continued from its seed; all runs take a byte at a time together."""
    out = ~seeds
    size = ends - starts
    for k in np.flatnonzero(size > SHORT_RUN).tolist():
        out[k] = zlib.crc32(data[starts[k] : ends[k]].tobytes(), int(seeds[k])) ^ 0xFFFFFFFF
    active = np.flatnonzero(size <= SHORT_RUN)
    for j in range(SHORT_RUN):
        active = active[size[active] > j]
        if not len(active):
            break
        now = out[active]
        out[active] = _STEP[(now & np.uint32(0xFF)) ^ data[starts[active] + j]] ^ (now >> np.uint32(8))
    return ~out


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The runs as an Arrow string column."""
    size = ends - starts
    stops = np.cumsum(size)
    total = int(stops[-1]) if len(stops) else 0
    at = np.arange(total) + np.repeat(starts - (stops - size), size)
    offsets = np.concatenate([[0], stops]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data[at])).cast(pa.string())


def _repeated(counts: dict[str, int]) -> pa.Array:
    return pa.array([w for w, n in counts.items() for _ in range(n)], pa.string())


# ---- index and search ------------------------------------------------------------------------


class ForwardIndex:
    """FM-index of a delimited vocabulary, extended to the right, a code point at a time.

    Built over the reversed text, whose backward search appends to the pattern. ``step`` maps
    interval ends for a whole array of (symbol, rank) pairs: ranks are looked up in one sorted array of
    symbol and place, so the index needs a number for each symbol of the text.
    """

    def __init__(self, words: list[str]):
        sizes = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(points)
        ends = np.cumsum(sizes)
        self.n = int(ends[-1]) + len(words) + 1
        text = np.zeros(self.n, np.int64)
        # word k stands reversed behind delimiter k: its j-th letter at end - j
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(points)) - (ends - sizes)[word]
        text[ends[word] + word - place] = np.searchsorted(self.alphabet, points) + 1
        self.delimiters = np.flatnonzero(text == 0)
        self.suffixes = _sorted_suffixes(text, len(self.alphabet) + 1)
        before = text[self.suffixes - 1]
        order = np.argsort(before, kind="stable")
        self.keys = before[order] * (self.n + 1) + order
        self.before = before

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text; -1 for code points that the index does not have."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, -1)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns extended by one symbol each (0: delimiter)."""
        base = symbol * (self.n + 1)
        a, b = np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)
        return np.where(symbol < 0, 0, a), np.where(symbol < 0, 0, b)

    def word(self, low: np.ndarray) -> np.ndarray:
        """Number of the word whose closing delimiter heads the suffix of this rank."""
        return np.searchsorted(self.delimiters, self.suffixes[low])

    def extensions(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, symbol): every letter that can follow, each once for an interval."""
        size, n = high - low, len(self.alphabet) + 1
        many = np.flatnonzero(size > n)
        few = np.flatnonzero(size <= n)
        width = size[few]
        row = np.repeat(few, width)
        at = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width) + low[row]
        found = np.unique(row * n + self.before[at])
        every = (many[:, None] * n + np.arange(1, n)[None]).ravel()
        found = np.concatenate([found[found % n > 0], every])
        return found // n, found % n


def _sorted_suffixes(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array by prefix doubling, from as many symbols as fit into one number."""
    n = len(text)
    bits = max(1, int(symbols).bit_length())
    packed, width = text.copy(), 1
    while 2 * width * bits <= 62:
        after = np.zeros(n, np.int64)
        after[: n - width] = packed[width:] if n > width else 0
        packed = (packed << (width * bits)) | after
        width *= 2
    while True:
        order = np.argsort(packed, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(packed[order][1:] != packed[order][:-1])]) + 1
        if rank[order[-1]] == n or width >= n:
            return order
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:]
        packed = rank * (n + 1) + after
        width *= 2


def one_edit_matches(index: ForwardIndex, patterns: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, word) for words that one edit behind the first ``exact`` symbols separates; pairs may repeat."""
    size = np.array([len(p) for p in patterns], np.int64)
    begin = np.cumsum(size) - size
    symbols = np.append(index.symbols("".join(patterns)), 0)  # behind the last pattern: read, never used
    zero = np.zeros(len(patterns), np.int64)
    # pattern, symbols read, interval; whether the edit is spent
    p, j, low, high, spent = np.arange(len(patterns)), zero, zero, zero + len(index.delimiters), zero.astype(bool)
    pairs = []
    while len(p):
        at_end = j == size[p]
        done = at_end & spent
        a, b = index.step(np.zeros(int(done.sum()), np.int64), low[done], high[done])
        hit = b > a
        pairs.append((p[done][hit], index.word(a[hit])))
        # read the next symbol as it is
        go = ~at_end
        a, b = index.step(symbols[begin[p[go]] + j[go]], low[go], high[go])
        nexts = [(p[go], j[go] + 1, a, b, spent[go])]
        # or spend the edit: leave the symbol out, or read another one in its place or before it
        free = ~spent & (j >= exact[p])
        skip = free & ~at_end
        nexts.append((p[skip], j[skip] + 1, low[skip], high[skip], ~spent[skip]))
        where = np.flatnonzero(free)
        k, symbol = index.extensions(low[where], high[where])
        k = where[k]
        other = at_end[k] | (symbols[np.minimum(begin[p[k]] + j[k], len(symbols) - 1)] != symbol)
        k, symbol = k[other], symbol[other]
        a, b = index.step(symbol, low[k], high[k])
        nexts.append((p[k], j[k], a, b, ~spent[k]))
        swap = ~at_end[k]
        nexts.append((p[k][swap], j[k][swap] + 1, a[swap], b[swap], ~spent[k][swap]))
        p, j, low, high, spent = (np.concatenate(c) for c in zip(*nexts, strict=True))
        alive = high > low
        p, j, low, high, spent = p[alive], j[alive], low[alive], high[alive], spent[alive]
    return np.concatenate([a for a, _ in pairs] or [zero[:0]]), np.concatenate([b for _, b in pairs] or [zero[:0]])


def _search(bucket: pa.Table) -> pa.Table:
    """Near words of one bucket: (word, near, near_n)."""
    posted = bucket.filter(bucket["posted"])
    asking = bucket.filter(bucket["asks"])["word"].to_pylist()
    p, found = np.empty(0, np.int64), np.empty(0, np.int64)
    if posted.num_rows and asking:
        backwards = bucket["backwards"][0].as_py()
        turned = (lambda w: w[::-1]) if backwards else (lambda w: w)
        index = ForwardIndex([turned(w) for w in posted["word"].to_pylist()])
        pairs = []
        for k in range(0, len(asking), TOGETHER):
            some = asking[k : k + TOGETHER]
            # first halves are the shorter ones where a word cannot be cut evenly
            exact = np.array([(len(w) + backwards) // 2 for w in some], np.int64)
            a, b = one_edit_matches(index, [turned(w) for w in some], exact)
            pairs.append(np.unique((a + k) * posted.num_rows + b))
        p, found = np.divmod(np.concatenate(pairs), posted.num_rows)
    words = pa.array(asking, pa.string())
    return pa.table({"word": words.take(pa.array(p)), "near": posted["word"].take(pa.array(found)), "near_n": posted["n"].take(pa.array(found))})


# ---- buckets ---------------------------------------------------------------------------------


def _half(word: Column, length: Column, backwards: bool) -> Column:
    """The half that a word of ``length`` asks by, at that end of ``word``."""
    return F.right(word, length - F.floor(length / 2)) if backwards else F.left(word, F.floor(length / 2))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every pair of words (word, n) that one edit separates, in both directions."""
    own = only(words, word="word", n="n")
    total = own.agg(F.count("*")).first()[0]
    buckets = max(1, math.ceil(4 * total / BUCKET_WORDS))
    word, length = F.col("word"), F.char_length("word")
    sides = []
    for backwards in (False, True):
        halves = F.array_distinct(F.array(*[_half(word, length + d, backwards) for d in (-1, 0, 1)]))
        sides.append(
            own.select(
                "word", "n", F.lit(backwards).alias("backwards"), _half(word, length, backwards).alias("own_half"), F.explode(halves).alias("half")
            )
        )
    posted = sides[0].unionByName(sides[1]).select("word", "n", "backwards", "half", (F.col("half") == F.col("own_half")).alias("asks"))
    most = max(1, BUCKET_WORDS // 4)
    large = posted.groupBy("backwards", "half").agg(F.count("*").alias("size")).where(F.col("size") > most)
    parts = large.select("backwards", "half", F.ceil(F.col("size") / most).cast("int").alias("parts"))
    dealt = posted.join(parts, ["backwards", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("word"), F.col("parts").cast("bigint")).cast("int")
    part = F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(mine)))
    bucket = F.pmod(F.xxhash64("half", "part"), F.lit(buckets)).cast("int")
    dealt = dealt.withColumn("mine", mine).withColumn("part", part)
    rows = dealt.groupBy("backwards", bucket.alias("bucket"), "word", "n").agg(
        F.max(F.col("part") == F.col("mine")).alias("posted"), F.max("asks").alias("asks")
    )
    found = rows.groupBy("backwards", "bucket").applyInArrow(_search, "word string, near string, near_n bigint")
    return found.distinct()


# ---- forms and roots -------------------------------------------------------------------------


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n) whose words are distinct.

    A word's form is its near word of largest n, if that is at least TIMES its own n; its root is the last word
    that forms lead to, or the word itself.
    """
    own = stored(only(words, word="word", n="n"), "words")
    near = near_words(own).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    joined = own.join(near, "word", "left").withColumn("most", -F.col("best.order"))
    formed = F.col("most") >= TIMES * F.col("n")
    named = stored(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(formed, F.col("best.near")).alias("form"),
            F.when(formed, F.col("most")).alias("form_n"),
        ),
        "forms",
    )
    return named.join(roots(named), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(named: DataFrame) -> DataFrame:
    """(word, root) for words that have a form. Every round doubles the steps that a pointer spans.

    n grows by TIMES at every step, so the largest n bounds the number of steps and of rounds.
    """
    reach = named.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    top = named.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(max(top, 1), TIMES)))
    for _ in range(math.ceil(math.log2(steps + 1))):
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reach = stored(reach.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return reach
