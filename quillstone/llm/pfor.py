"""Patched frame-of-reference coding of 32-bit ids, in self-contained segments.

A segment, all little-endian::

    magic "QPF1" | block size u32 | documents u64 | ids u64 | blocks u64 | exceptions u64
    per document: doc_id i64, null flag u8, ids u32
    per block:    start of its packed bytes u64 (the index), minimum u32, width u8, exceptions u16
    packed bytes of all blocks; then the exceptions' places u8 and high bits u32

A block holds BLOCK ids less their minimum, packed at the width that holds PERCENTILE percent of them. The bits above that
width of the other ids are in the exception list.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK, PERCENTILE, MAGIC = 128, 90, b"QPF1"
_HEAD = struct.Struct("<4sIQQQQ")


def _bits(x: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Low `width` bits of (k, BLOCK) values as (k, BLOCK * width / 8) bytes."""
    if width == 32:
        return rows.astype("<u4").view(np.uint8).reshape(len(rows), -1)
    if width == 16:
        return rows.astype("<u2").view(np.uint8).reshape(len(rows), -1)
    lanes = np.ascontiguousarray(rows.T).astype(np.uint64) & np.uint64((1 << width) - 1)
    out = np.zeros((BLOCK * width // 64, len(rows)), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8)


def _unpack(data: np.ndarray, width: int) -> np.ndarray:
    if width == 32:
        return np.ascontiguousarray(data).view("<u4").astype(np.uint32)
    if width == 16:
        return np.ascontiguousarray(data).view("<u2").astype(np.uint32)
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").T)
    out = np.empty((BLOCK, len(data)), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[i] = words[word] >> np.uint64(shift)
        if shift + width > 64:
            out[i] |= words[word + 1] << np.uint64(64 - shift)
    return np.ascontiguousarray((out & np.uint64((1 << width) - 1)).T).astype(np.uint32)


def encode(ids: np.ndarray, doc_ids: list[int | None], counts: np.ndarray) -> bytes:
    """One segment of the documents' ids, which stand one after another."""
    blocks = -(-len(ids) // BLOCK)
    padded = np.full(blocks * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(blocks, BLOCK)
    low = rows.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rows = rows - low[:, None]
    bits = _bits(rows)
    at = (BLOCK * PERCENTILE + 99) // 100 - 1
    width = np.partition(bits, at, axis=1)[:, at] if blocks else np.zeros(0, np.uint8)
    outlier = bits > width[:, None]
    n_out = outlier.sum(axis=1).astype("<u2")
    sizes = width.astype(np.int64) * (BLOCK // 8)
    starts = np.zeros(blocks, np.int64)
    np.cumsum(sizes[:-1], out=starts[1:]) if blocks else None
    packed = np.empty(int(sizes.sum()), np.uint8)
    for w in np.unique(width):
        if w:
            which = np.flatnonzero(width == w)
            packed[starts[which][:, None] + np.arange(BLOCK // 8 * int(w))] = _pack(rows[which], int(w))
    block, place = np.nonzero(outlier)
    high = rows[block, place] >> width[block].astype(np.uint32)
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    parts = (docs, null, np.asarray(counts, "<u4"), starts.astype("<u8"), low.astype("<u4"), width.astype(np.uint8), n_out, packed, place.astype(np.uint8), high.astype("<u4"))
    return _HEAD.pack(MAGIC, BLOCK, len(docs), len(ids), blocks, len(place)) + b"".join(p.tobytes() for p in parts)


class Segment:
    """A segment read back: doc_ids, counts, ids() and block(i)."""

    def __init__(self, data: bytes):
        magic, size, n_docs, self.n_ids, blocks, n_out = _HEAD.unpack_from(data)
        if magic != MAGIC or size != BLOCK:
            raise ValueError("not a segment of this format")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        docs, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(docs, null, strict=True)]
        self.counts = take("<u4", n_docs).astype(np.int64)
        self.starts, self.low, self.width, self.n_out = take("<u8", blocks).astype(np.int64), take("<u4", blocks), take("u1", blocks), take("<u2", blocks)
        self.packed = take("u1", int(self.width.sum(dtype=np.int64)) * (BLOCK // 8))
        self.place, self.high = take("u1", n_out), take("<u4", n_out)
        self.first_out = np.concatenate([[0], np.cumsum(self.n_out, dtype=np.int64)])

    def _rows(self, which: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(which), BLOCK), np.uint32)
        width = self.width[which]
        for w in np.unique(width):
            if w:
                own = np.flatnonzero(width == w)
                rows[own] = _unpack(self.packed[self.starts[which[own]][:, None] + np.arange(BLOCK // 8 * int(w))], int(w))
        n = self.n_out[which].astype(np.int64)
        row = np.repeat(np.arange(len(which)), n)
        k = np.repeat(self.first_out[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(which) else np.zeros(0, np.int64)
        rows[row, self.place[k]] |= self.high[k] << width[row].astype(np.uint32)
        return rows + self.low[which][:, None]

    def ids(self) -> np.ndarray:
        return self._rows(np.arange(len(self.starts))).reshape(-1)[: self.n_ids]

    def block(self, i: int) -> np.ndarray:
        """The ids of one block, by the index of block starts."""
        return self._rows(np.array([i]))[0][: max(0, min(BLOCK, self.n_ids - i * BLOCK))]
