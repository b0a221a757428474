"""Byte-pair merges of many short pieces at once, on arrays.

Pieces of equal length are rows of one matrix. Every round merges, in every row that still has a
known pair, the leftmost pair of the lowest rank; so all rows left have the same length.
"""

from __future__ import annotations

import json

import numpy as np

LONGEST = 40  # bytes; longer pieces are rare and go to the library
_NONE = np.int32(2**31 - 1)


def byte_symbols() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Merges:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.of_byte = np.array([vocab[s] for _, s in sorted(byte_symbols().items())], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.uint64)
        right = np.array([vocab[b] for _, b in pairs], np.uint64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = (left << np.uint64(20)) | right
        ranks = np.arange(len(keys), dtype=np.int32)
        self.tables = []
        bits = max(10, int(len(keys)).bit_length() + 4)
        # each table takes the keys that do not collide, the next one the rest
        while len(keys):
            m = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.tables) * 0x51ED2701)
            at = (keys * m) >> np.uint64(64 - bits)
            _, first = np.unique(at, return_index=True)
            table_keys, table_ranks = np.full(1 << bits, 2**63, np.uint64), np.full(1 << bits, _NONE, np.int32)
            table_keys[at[first]], table_ranks[at[first]] = keys[first], ranks[first]
            self.tables.append((m, np.uint64(64 - bits), table_keys, table_ranks))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ranks = keys[rest], ranks[rest]
            bits = max(10, int(len(keys)).bit_length() + 6)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a.astype(np.uint64) << np.uint64(20)) | b.astype(np.uint64)
        out = np.full(keys.shape, _NONE, np.int32)
        for m, shift, table_keys, table_ranks in self.tables:
            at = (keys * m) >> shift
            same = table_keys[at] == keys
            out[same] = table_ranks[at[same]]
        return out

    def __call__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Number of tokens of every piece (of LONGEST bytes at most), and (pieces, ids matrix) groups."""
        counts = np.zeros(len(starts), np.int64)
        groups = []
        for size in np.unique(lengths).tolist():
            row = np.flatnonzero(lengths == size)
            ids = self.of_byte[data[starts[row][:, None] + np.arange(size)]]
            rank = self.rank(ids[:, :-1], ids[:, 1:])
            for width in range(size, 0, -1):
                if width > 1:
                    at = rank.argmin(1)
                    best = rank[np.arange(len(row)), at]
                    open_ = best != _NONE
                else:
                    open_ = np.zeros(len(row), bool)
                counts[row[~open_]] = width
                groups.append((row[~open_], ids[~open_]))
                if not open_.any():
                    break
                row, at, best, ids, rank = row[open_], at[open_], best[open_], ids[open_], rank[open_]
                after = np.arange(width - 1)[None, :] > at[:, None]
                ids = np.where(after, ids[:, 1:], ids[:, :-1])
                every = np.arange(len(row))
                ids[every, at] = self.result[best]
                rank = np.where(after[:, :-1], rank[:, 1:], rank[:, :-1])
                has = at < width - 2
                rank[every[has], at[has]] = self.rank(ids[every[has], at[has]], ids[every[has], at[has] + 1])
                has = at > 0
                rank[every[has], at[has] - 1] = self.rank(ids[every[has], at[has] - 1], ids[every[has], at[has]])
        return counts, groups
