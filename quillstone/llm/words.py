"""Vectorised words, word hashes and shingles over Arrow string columns.

Words are maximal runs outside \\x20 and \\x09-\\x0D. A word's hash is a 64-bit polynomial over its bytes with random
byte values, mixed with its length; a shingle's hash mixes the hashes of its words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes hashed at once; a longer word is hashed by BLAKE2b instead.
SPAN = 1 << 20
_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) and the texts' offsets in them."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """starts, ends: byte places of all words; first: the index of each text's first word, and the number of words at the end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        word = ~SPACE[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        if n:
            before = np.ones(n, bool)
            before[1:] = edge[1:n] | ~word[:-1]
            after = np.ones(n, bool)
            after[:-1] = edge[1:n] | ~word[1:]
            self.starts, self.ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        out = np.empty(len(self.starts), np.uint64)
        i, n = 0, len(out)
        while i < n:
            j = max(int(np.searchsorted(self.ends, self.starts[i] + SPAN, "right")), i + 1)
            a, b = int(self.starts[i]), int(self.ends[j - 1])
            if b - a > SPAN:
                out[i] = int.from_bytes(hashlib.blake2b(self.data[a:b].tobytes(), digest_size=8).digest(), "little")
            else:
                out[i:j] = _hash(self.data[a:b], self.starts[i:j] - a, self.ends[i:j] - a)
            i = j
        return out


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(SPAN + 1, np.uint64(base))
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    up, down = _powers
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of `size` words; of the whole sequence where it is shorter."""
    k = min(size, len(words))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(words) - k + 1
    total = np.full(n, np.uint64(k))
    for t in range(k):
        total += words[t : t + n] * _WORD[t]
    return mix(total)
