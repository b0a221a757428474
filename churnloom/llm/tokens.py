"""Token counts and token ids of byte-level BPE by a compiled finite-state transducer.

The pattern that cuts a text into pieces for BPE is compiled to a deterministic transducer over
classes of characters: each transition says where the next piece begins. It runs on all chunks of
the texts side by side. First every chunk gets its state map (the end state for every start
state); the maps are composed by a parallel prefix scan, which gives each chunk its start state;
then the chunks emit their piece boundaries. Texts are separated by a reset class, which maps
every state to the start.

A transition that ends a piece emits that piece's number of tokens (or its ids). These
annotations are compiled when a piece is first seen: its tokens depend on the piece alone, so
the merges run once for each distinct piece (all new ones of a slice at once) and are kept in a table
keyed by a 64-bit hash, which starts anew beyond ``TABLE`` pieces (results are the same). BPE inside a piece has no finite transducer of useful size for 50,000 merges, hence the
table in place of states for partial merges.

Special strings inside texts become one token, as the library does by default. A null text is
empty: no bytes, no tokens.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnloom.llm.bpe import LONGEST, Merges
from churnloom.llm.text import by_size, mix64, powers

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CHUNK = 64
#: distinct pieces whose tokens a Python worker remembers
TABLE = 1 << 19
#: pieces that gather before they are merged into the large table
RECENT = 1 << 16
SLICE = 1 << 20  # text bytes worked on at once

# classes of characters
LETTER, DIGIT, SPACE, GAP, OTHER, QUOTE, RESET = range(7)
# s t m d end a contraction alone; r v l begin one of two letters
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point: letters, digits, white space, the rest."""
    import regex

    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\s+", GAP)):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    out[0x1C:0x20] = OTHER  # separators that only Python counts as white space
    out[0xD800:0xE000] = OTHER
    out[0x20], out[0x27] = SPACE, QUOTE
    return out


# States: what the piece that the last character belongs to is. A run of white space gives its
# last character to the piece after it when that character is a plain space; every other piece
# of white space ends before its last character if something follows. Both are decided one
# character late, so the transducer marks boundaries at or one before the current character.
START, IN_LETTERS, IN_DIGITS, IN_OTHER, ONE_SPACE, ONE_GAP, MORE_SPACE, MORE_GAP = range(8)
HERE, BEFORE = 1, 2


def _compile() -> tuple[np.ndarray, np.ndarray]:
    """Next state and boundary marks for every (class, state)."""
    step = np.zeros((7, 8), np.uint8)
    mark = np.zeros((7, 8), np.uint8)
    body = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHER, QUOTE: IN_OTHER}
    for state in range(8):
        for kind, inside in body.items():
            step[kind, state] = inside
            if state == ONE_SPACE:
                mark[kind, state] = 0  # the space leads the piece
            elif state == MORE_SPACE:
                mark[kind, state] = BEFORE
            elif state == MORE_GAP:
                mark[kind, state] = HERE | BEFORE
            else:
                mark[kind, state] = 0 if state == inside else HERE
        for kind, one, more in ((SPACE, ONE_SPACE, MORE_SPACE), (GAP, ONE_GAP, MORE_GAP)):
            white = state in (ONE_SPACE, ONE_GAP, MORE_SPACE, MORE_GAP)
            step[kind, state] = more if white else one
            mark[kind, state] = 0 if white else HERE
        step[RESET, state], mark[RESET, state] = START, HERE
    return step, mark


STEP, MARK = _compile()


def run_transducer(kinds: np.ndarray) -> np.ndarray:
    """Boundary marks of every character, by chunk maps and a prefix scan over them."""
    n = len(kinds)
    rows = -(-n // CHUNK)
    grid = np.full((rows * CHUNK), RESET, np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
    step, mark = STEP.reshape(-1), MARK.reshape(-1)
    maps = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in grid:
        maps = step[(column[:, None] * np.uint8(8)) + maps]
    # inclusive scan: after it, row r maps the start of the text to the end of chunk r
    gap = 1
    while gap < rows:
        maps[gap:] = np.take_along_axis(maps[gap:], maps[:-gap].copy(), axis=1)
        gap *= 2
    state = np.concatenate([[START], maps[:-1, START]]).astype(np.uint8)
    out = np.empty_like(grid)
    for k, column in enumerate(grid):
        at = column * np.uint8(8) + state
        out[k] = mark[at]
        state = step[at]
    return out.T.reshape(-1)[:n]


def cut_pieces(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Begin of every piece. ``kinds`` ends with RESET; characters of class RESET are in no piece."""
    marks = run_transducer(kinds)
    begins = (marks & HERE) > 0
    begins[:-1] |= (marks[1:] & BEFORE) > 0
    # contractions: a quote that begins a piece and is followed by one of the suffixes
    at = np.flatnonzero((kinds[:-1] == QUOTE) & begins[:-1])
    pad = np.concatenate([codes, np.zeros(3, codes.dtype)])
    taken = np.zeros(len(at), np.int64)
    for s in SUFFIXES:
        same = taken == 0
        for k, c in enumerate(s):
            same &= pad[at + 1 + k] == ord(c)
        taken[same] = len(s)
    at, taken = at[taken > 0], taken[taken > 0]
    begins[at + 1] = False
    ends = at + 1 + taken
    begins[at[taken == 2] + 2] = False
    follow = kinds[np.minimum(ends, len(kinds) - 1)]
    # what comes after a contraction begins a piece, be it letters or punctuation
    begins[ends[follow != RESET]] = True
    return begins


def _hash_pieces(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    power, inverse = powers
    values = mix64((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * power[: len(codes)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * inverse[starts])


class Tokenizer:
    """Transducer with its table of annotated pieces, for one task."""

    def __init__(self, path: str, ids: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Vocabulary

        self.vocabulary = Vocabulary.from_file(path)
        self.vocabulary.no_truncation()
        self.vocabulary.no_padding()
        self.special = {t.content: k for k, t in self.vocabulary.get_added_tokens_decoder().items() if t.special}
        self.merges = Merges(path)
        self.classes, self.ids = classes(), ids
        self._clear()
        self._powers(SLICE + 4096)

    def _powers(self, n: int) -> None:
        base = 0xD1342543DE82EF95
        self.powers = tuple(powers(np.uint64(b), n + 1) for b in (base, pow(base, -1, 1 << 64)))

    def _clear(self) -> None:
        none = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
        # sorted keys with token counts and places of the ids; new pieces gather in the second table
        self.tables = [none, none]
        self.flat, self.used = np.empty(1 << 16 if self.ids else 0, np.int32), 0

    def _add(self, k: int, rows: tuple[np.ndarray, ...]) -> None:
        every = [np.concatenate(pair) for pair in zip(self.tables[k], rows, strict=True)]
        order = np.argsort(every[0])
        self.tables[k] = tuple(x[order] for x in every)

    def _annotate(self, keys: np.ndarray, pieces: Callable[[np.ndarray], list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of pieces and where their ids begin, after the pieces not yet known have been added."""
        if len(self.tables[0][0]) > TABLE:
            self._clear()
        elif len(self.tables[1][0]) > RECENT:
            recent, self.tables[1] = self.tables[1], tuple(x[:0] for x in self.tables[1])
            self._add(0, recent)
        counts, starts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for known, n, begin in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                same = known[at] == keys
                counts[same], starts[same] = n[at[same]], begin[at[same]]
        new = np.flatnonzero(counts < 0)
        if len(new):
            counts[new], starts[new] = self._merge(pieces(new))
            self._add(1, (keys[new], counts[new].astype(np.int32), starts[new].astype(np.int32)))
        return counts, starts

    def _merge(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and places of the ids of new pieces."""
        raw = [x.encode() for x in found]
        data = np.frombuffer(b"".join(raw), np.uint8)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        begins = np.cumsum(lengths) - lengths
        short = np.flatnonzero(lengths <= LONGEST)
        counts = np.zeros(len(found), np.int64)
        counts[short], groups = self.merges(data, begins[short], lengths[short])
        long = {k: self.vocabulary.encode(found[k], add_special_tokens=False).ids for k in np.flatnonzero(lengths > LONGEST).tolist()}
        for k, ids in long.items():
            counts[k] = len(ids)
        starts = self.used + np.cumsum(counts) - counts
        if self.ids:
            self.used += int(counts.sum())
            if self.used > len(self.flat):
                self.flat = np.concatenate([self.flat, np.empty(max(self.used - len(self.flat), len(self.flat) // 2), np.int32)])
            for row, ids in groups:
                self.flat[starts[short[row]][:, None] + np.arange(ids.shape[1])] = ids
            for k, ids in long.items():
                self.flat[starts[k] : starts[k] + len(ids)] = ids
        return counts, starts

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
        """Tokens of each text, and all ids in order if asked for."""
        rows = texts.fill_null("").to_pylist()
        marks: list[tuple[int, int, int]] = []  # place, length, id of special strings
        joined = "\x00".join(rows) + "\x00"
        lengths = np.fromiter(map(len, rows), np.int64, len(rows)) + 1
        ends = np.cumsum(lengths)
        for content, number in self.special.items():
            k = joined.find(content)
            while k >= 0:
                marks.append((k, len(content), number))
                k = joined.find(content, k + len(content))
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(codes) > len(self.powers[0]):
            self._powers(len(codes) + 1)
        kinds = self.classes[codes]
        kinds[ends - 1] = RESET
        for k, n, _ in marks:
            kinds[k : k + n] = RESET
        begins = cut_pieces(codes, kinds)
        cuts = np.flatnonzero(begins)
        piece = kinds[cuts] != RESET
        stops = np.append(cuts[1:], len(codes))[piece]
        starts = cuts[piece]
        keys = _hash_pieces(codes, starts, stops, self.powers)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        n, from_ = self._annotate(distinct, lambda new: [joined[starts[k] : stops[k]] for k in first[new]])
        counts, from_ = n[inverse], from_[inverse]
        where = starts
        if marks:
            where = np.concatenate([starts, [m[0] for m in marks]])
            counts = np.concatenate([counts, np.ones(len(marks), np.int64)])
        text = np.searchsorted(ends, where, side="right")
        totals = np.bincount(text, weights=counts, minlength=len(rows)).astype(np.int64)
        if not self.ids:
            return totals, None
        flat = self.flat[: self.used]
        if marks:
            from_ = np.concatenate([from_, len(flat) + np.arange(len(marks))])
            flat = np.concatenate([flat, np.array([m[2] for m in marks], np.int32)])
        order = np.argsort(where, kind="stable")
        from_, counts = from_[order], counts[order]
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return totals, flat[np.repeat(from_, counts) + offset]


@lru_cache(2)
def tokenizer(vocabulary: str, ids: bool) -> Tokenizer:
    """One for all tasks of a Python worker, so that its table is filled once."""
    return Tokenizer(vocabulary_path(vocabulary), ids)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_tokens(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY, count: str = "n_tokens", ids: str | None = None) -> DataFrame:
    """All rows with the number of tokens in ``count`` and, if named, the ids in ``ids``.

    ``vocabulary`` is the name of a file that every executor finds through its own tokenizer package.
    """
    out = docs.withColumn(count, F.lit(None).cast("bigint"))
    if ids:
        out = out.withColumn(ids, F.lit(None).cast("array<int>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_tokens = tokenizer(vocabulary, ids is not None)
        for batch in batches:
            for part in by_size(batch, text, SLICE):
                totals, flat = count_tokens(part.column(text))
                part = part.set_column(part.schema.get_field_index(count), count, pa.array(totals))
                if ids:
                    ends = pa.array(np.concatenate([[0], np.cumsum(totals)]), pa.int32())
                    part = part.set_column(part.schema.get_field_index(ids), ids, pa.ListArray.from_arrays(ends, pa.array(flat)))
                yield part

    return out.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema]))


def token_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    n = with_tokens(own, vocabulary=vocabulary)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return n.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
