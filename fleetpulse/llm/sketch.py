"""Mergeable count-min sketches, built by tasks and merged block by block.

``RepeatSketch`` keeps counters that saturate at two, as two bit tables per
row ("seen", "seen again"), since its users only ask whether a value is
repeated; it never underestimates. Its width is chosen from the size of the
data, up to ``MAX_BITS``: beyond that the estimate gets looser, never wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.textcore import U, mix

ROWS = 2
MIN_BITS, MAX_BITS = 16, 26         # at most 2^26 counters a row: 32 MB in all
BLOCK = 1 << 16
SALTS = (U(0x9E3779B97F4A7C15), U(0x3C6EF372FE94F82A))     # fixed values, one per row


def bits_for(values: int, load: float = 0.25) -> int:
    return min(MAX_BITS, max(MIN_BITS, int(np.ceil(np.log2(max(1, values) / load)))))


class RepeatSketch:
    def __init__(self, bits: int, data: bytes | None = None):
        self.bits = bits
        size = ROWS << (bits - 3)
        self.data = np.zeros(2 * size, np.uint8) if data is None else np.frombuffer(data, np.uint8)
        self.seen, self.again = self.data[:size], self.data[size:]

    def cells(self, h: np.ndarray, row: int) -> np.ndarray:
        x = (mix(h + SALTS[row]) >> U(64 - self.bits)).astype(np.int64)
        return x + (row << self.bits)

    def add(self, h: np.ndarray) -> None:
        for row in range(ROWS):
            cell, n = np.unique(self.cells(h, row), return_counts=True)
            byte, bit = cell >> 3, (1 << (cell & 7)).astype(np.uint8)
            more = (n > 1) | ((self.seen[byte] & bit) > 0)
            np.bitwise_or.at(self.again, byte[more], bit[more])
            np.bitwise_or.at(self.seen, byte, bit)

    def repeated(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for row in range(ROWS):
            cell = self.cells(h, row)
            out &= (self.again[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
        return out


    def contains(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for row in range(ROWS):
            cell = self.cells(h, row)
            out &= (self.seen[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
        return out


def _blocks(rows: dict[int, list[bytes]]) -> pa.RecordBatch:
    keys = sorted(rows)
    return pa.record_batch([pa.array(keys, pa.int32()), pa.array([rows[k][0] for k in keys], pa.binary()),
                            pa.array([rows[k][1] for k in keys], pa.binary())], names=["block", "x", "y"])


def build_repeat_sketch(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> bytes:
    """One sketch of what ``hashes`` gives over all batches of ``df``. Each
    task fills a sketch; blocks of equal place meet in one task and merge as
    they stream in. The result is at most 32 MB."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = None
        for batch in batches:
            s = s or RepeatSketch(bits)
            s.add(hashes(batch))
        if s is not None:
            for k in range(0, len(s.seen), BLOCK):
                x = s.seen[k:k + BLOCK]
                if x.any():
                    yield _blocks({k // BLOCK: [x.tobytes(), s.again[k:k + BLOCK].tobytes()]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                if k in have:
                    a, b = have[k]
                    x, y = a | x, b | y | (a & x)
                have[k] = x, y
        for k in sorted(have):
            yield _blocks({k: [have[k][0].tobytes(), have[k][1].tobytes()]})

    schema = "block int, x binary, y binary"
    merged = df.mapInArrow(partial, schema).repartition("block").mapInArrow(merge, schema)
    out = RepeatSketch(bits)
    for row in merged.collect():             # in one job, not one a partition
        k = row["block"] * BLOCK
        x, y = np.frombuffer(row["x"], np.uint8), np.frombuffer(row["y"], np.uint8)
        out.seen[k:k + len(x)], out.again[k:k + len(y)] = x, y
    return out.data.tobytes()


def build_counts(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """A one-row count-min sketch with 16-bit counters that saturate
    (at most 8 MB at 22 bits): counts never come out too low before 65,535."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            cell, n = np.unique((hashes(batch) >> U(64 - bits)).astype(np.int64), return_counts=True)
            total[cell] += n.astype(np.uint32)
        total = np.minimum(total, 65535).astype("<u2")
        for k in range(0, len(total), BLOCK):
            if total[k:k + BLOCK].any():
                yield pa.record_batch([pa.array([k // BLOCK], pa.int32()),
                                       pa.array([total[k:k + BLOCK].tobytes()], pa.binary())], names=["block", "x"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                have[k] = have.get(k, 0) + np.frombuffer(x, "<u2").astype(np.uint64)
        for k in sorted(have):
            x = np.minimum(have[k], U(65535)).astype("<u2")
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())],
                                  names=["block", "x"])

    out = np.zeros(1 << bits, "<u2")
    for row in df.mapInArrow(partial, "block int, x binary").repartition("block") \
            .mapInArrow(merge, "block int, x binary").collect():
        x = np.frombuffer(row["x"], "<u2")
        out[row["block"] * BLOCK:row["block"] * BLOCK + len(x)] = x
    return out


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column, over all rows."""
    return df.agg(F.sum(F.octet_length(F.col(column).cast("string")).cast("long"))).first()[0] or 0
