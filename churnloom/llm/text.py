"""Whole-text word hashing for tasks that work on Arrow batches.

Texts are read as UTF-8 bytes; every separator is ASCII, so words can be cut on bytes. Work is
done in pieces of 256 kB, cut between words, so memory does not depend on how long
one text is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bytes(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in spans:
        out[low : high + 1] = True
    return out


#: bytes that end a word: white space, or everything ASCII but digits and letters
SPACES = _bytes((0x20, 0x20), (0x09, 0x0D))
NOT_LETTERS = _bytes((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
NOTHING = _bytes()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_VALUE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)[_LOWER] | np.uint64(1)


class WordHasher:
    """Cuts texts into words, A-Z lower-cased, and gives a 64-bit hash of each.

    ``gap`` marks the bytes between words. With ``runs``, a run of gap bytes that are not white
    space counts as a word too (so punctuation is seen).
    """

    def __init__(self, gap: np.ndarray, runs: bool = False):
        low = _LOWER.copy()
        self.kind = (~gap[low]).astype(np.int8)
        if runs:
            self.kind[gap[low] & ~SPACES] = 2
        self._grow(PIECE + (1 << 16))

    def _grow(self, n: int) -> None:
        base = np.uint64(0xD1342543DE82EF95)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.power, self.inverse = powers(base, n), powers(inverse, n)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and how many each text has (null: none)."""
        data, offsets = text_bytes(texts)
        parts, places = [], []
        at = 0
        while at < len(data):
            end = self._cut(data, at, offsets)
            starts, hashes = self._piece(data[at:end], offsets, at)
            parts.append(hashes)
            places.append(starts)
            at = end
        hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        starts = np.concatenate(places) if places else np.empty(0, np.int64)
        return hashes, np.diff(np.searchsorted(starts, offsets))

    def _cut(self, data: np.ndarray, at: int, offsets: np.ndarray) -> int:
        end = min(at + PIECE, len(data))
        while end < len(data) and self.kind[data[end - 1]]:
            step = np.flatnonzero(self.kind[data[end : end + 4096]] == 0)
            if len(step):
                return end + int(step[0]) + 1
            end = min(end + 4096, len(data))
        return end

    def _piece(self, data: np.ndarray, offsets: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if n > len(self.power):
            self._grow(n)
        kind = self.kind[data]
        edge = np.empty(n + 1, bool)
        edge[0] = edge[n] = True
        np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + n)] - at
        edge[inside] = True
        cuts = np.flatnonzero(edge)
        word = kind[cuts[:-1]] > 0
        starts, ends = cuts[:-1][word], cuts[1:][word]
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_VALUE[data] * self.power[:n], out=sums[1:])
        return starts + at, mix64((sums[ends] - sums[starts]) * self.inverse[starts])


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and the n + 1 places where its texts begin."""
    texts = texts.cast(pa.large_string()).fill_null("")
    buffers = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(buffers[1], np.int64, count=texts.offset + n + 1)[texts.offset :] if n else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(buffers[2], np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    return data, offsets - low


def give_back() -> None:
    """Return freed memory to the system, so that idle workers do not hold what a batch once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def by_size(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` text bytes; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end
    give_back()


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place (only the first len - n + 1 are whole)."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        out = out * _ODD + words[k : k + len(out)]
    return mix64(out)
