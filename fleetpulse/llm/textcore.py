"""Vectorised word hashing over Arrow string columns.

A batch's texts lie in one UTF-8 buffer. Words are found with a byte table
and hashed by polynomial prefix sums (arithmetic modulo 2^64, odd bases, so
any slice's hash follows from two prefix values), never as Python strings.
Memory follows the batch: prefix sums are taken over pieces of about
``PIECE`` bytes, cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
U = np.uint64

# Odd multipliers (two hash lanes) and mixing constants.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIX1, MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base^i, base^-i) modulo 2^64 for i < n at least."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        up, down = np.full(size, U(base)), np.full(size, U(pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        have = _powers[base] = (np.cumprod(up), np.cumprod(down))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX1
    x = (x ^ (x >> U(27))) * MIX2
    return x ^ (x >> U(31))


def slices_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for every pair (start, end)."""
    up, down = powers(base, len(values) + 1)
    p = np.zeros(len(values) + 1, U)
    np.cumsum(values.astype(U) * up[:len(values)], out=p[1:])
    return mix((p[end] - p[start]) * down[start] + (end - start).astype(U) * MIX1)


class Words:
    """Words of every text of a batch: ``lane(k)`` gives one 64-bit hash per
    word, ``first[d]:first[d + 1]`` are the words of text d."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        col = texts.cast(pa.large_string()).fill_null("")
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        data = col.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        raw = raw[off[0]:off[-1]] if len(off) else raw[:0]
        off = off - off[0]
        self.raw = _LOWER[raw] if lower else raw
        if len(raw):
            space = _SPACE[raw]
            begins = np.zeros(len(raw) + 1, bool)
            begins[off] = True                                   # a text begins (or the batch ends)
            before = np.concatenate([[True], space[:-1]]) | begins[:-1]
            after = np.concatenate([space[1:], [True]]) | begins[1:]
            self.start = np.flatnonzero(~space & before)
            self.end = np.flatnonzero(~space & after) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)

    def lane(self, k: int = 0) -> np.ndarray:
        out = np.empty(len(self.start), U)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.start, self.start[i] + PIECE)))
            lo, hi = self.start[i], self.end[j - 1]
            out[i:j] = slices_hash(self.raw[lo:hi].astype(U) + U(1), self.start[i:j] - lo, self.end[i:j] - lo,
                                   BASES[k])
            i = j
        return out

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def windows(lane: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of the k words from each position on (positions nearer than k
    to the end of the batch are left out)."""
    n = len(lane) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out, step = np.empty(n, U), PIECE // 8
    for i in range(0, n, step):
        j = min(n, i + step)
        at = np.arange(j - i)
        out[i:j] = slices_hash(lane[i:j + k - 1], at, at + k, base)
    return out


def sequence_keys(lanes: list[np.ndarray], first: np.ndarray) -> list[bytes]:
    """A 16-byte key of each text's word sequence."""
    parts = []
    for lane, base in zip(lanes, BASES):
        p = np.empty(len(first) - 1, U)
        for d in range(len(p)):
            v = lane[first[d]:first[d + 1]]
            p[d] = (v * powers(base, len(v) + 1)[0][:len(v)]).sum(dtype=U)
        parts.append(mix(p + np.diff(first).astype(U) * MIX2))
    return [x.tobytes() for x in np.stack(parts, axis=1)] if len(first) > 1 else []


def slabs(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds about ``limit`` bytes of text (or
    one text, if longer)."""
    import pyarrow.compute as pc
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, at = np.cumsum(size), 0
        while at < batch.num_rows:
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
