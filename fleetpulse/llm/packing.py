"""Packing documents into training windows by Karmarkar-Karp differencing.

Every document becomes ids (tokenizers' byte-level BPE, then a separator).
Full windows are cut off a document's front; what is left (shorter than a
window) is cut into pieces of at most ``piece`` ids, and the pieces of a
group of documents are spread over k windows by multiway differencing: each
piece starts as a partial partition, the two partial partitions with the
largest spread merge with opposing imbalances (the fullest window of one
meets the emptiest of the other) until one is left. k starts at the least
number that could hold the ids; while a window exceeds the capacity, k
rises. Pieces are small against the window, so the windows come out near
equal and little is padded.

A task packs its own rows in groups of at most ``group`` documents, so
memory is bounded, nothing is shuffled, and a hot source does not matter.
A retried task reads the same file split and gives the same windows.

Defined cases: a null or empty text is the separator alone; repeated rows
and null ids are packed row by row; a special string of the tokenizer that
stands in a text becomes its one id, as the library does by default; an empty
table gives no windows.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.bpe_words import MARKS, ChunkEncoder
from fleetpulse.llm.textcore import slabs

WINDOW = 1024
PIECE = 256
GROUP = 512
SEPARATOR = 0
RUN = 4096            # chunks given to the tokenizer in one string
CHUNKS = 1_000_000    # chunks a worker remembers, some 60 MB; only speed depends on it


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Split items into k lists of near-equal sums (their indices)."""
    # A partial partition is its sums in falling order; merges are kept as a
    # tree and the items are handed to the windows at the end, from its root.
    heap, merges = [], []
    for i, s in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = s
        heap.append((-s, i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, sums_a = heapq.heappop(heap)
        _, b, sums_b = heapq.heappop(heap)
        sums = sums_a + sums_b[::-1]             # fullest with emptiest
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), len(sizes) + len(merges), sums))
        merges.append((a, b, order))
    parts: list[list[int]] = [[] for _ in range(k)]
    window_of = {len(sizes) + len(merges) - 1: np.arange(k)}     # of a partial partition's slots
    for m in range(len(merges) - 1, -1, -1):
        a, b, order = merges[m]
        at = np.empty(k, np.int64)
        at[order] = window_of.pop(len(sizes) + m)
        window_of[a], window_of[b] = at, at[::-1]
        for child in (a, b):
            if child < len(sizes):
                parts[window_of.pop(child)[0]].append(child)
    if len(sizes) == 1:
        parts[0].append(0)
    return [p for p in parts if p]


def pack(sizes: list[int], window: int) -> list[list[int]]:
    """The fewest windows that differencing fills without excess."""
    k = max(1, -(-sum(sizes) // window))
    while True:
        parts = differencing(sizes, k)
        if all(sum(sizes[i] for i in p) <= window for p in parts):
            return parts
        k += 1


blank = regex.compile(r"\p{White_Space}").search


class _Whole:
    """Every text on its own, as the library takes it."""

    def __init__(self, encode):
        self.texts = encode


_workers: dict[int, ChunkEncoder | _Whole] = {}


def _worker(spec: str) -> ChunkEncoder | _Whole:
    key = hash(spec)
    if key not in _workers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(spec)
        vocabulary = tokenizer.get_vocab()
        width = np.zeros(max(vocabulary.values()) + 1, np.int64)      # bytes of each id
        for token, i in vocabulary.items():
            width[i] = len(token)
        added = tokenizer.get_added_tokens_decoder()
        for i, token in added.items():                                # these stand for themselves
            width[i] = len(token.content.encode())

        def encode(strings: list[str]) -> list[bytes]:
            coded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
            return [np.array(x.ids, "<u4").tobytes() for x in coded]

        def encode_chunks(chunks: list[str]) -> list[bytes]:
            # No token crosses the space that a chunk begins with, so chunks are tokenized in
            # long runs; the bytes of the ids tell where each chunk's ids end.
            ends = np.cumsum([len(c.encode()) for c in chunks], dtype=np.int64)
            runs = ["".join(chunks[k:k + RUN]) for k in range(0, len(chunks), RUN)]
            coded = tokenizer.encode_batch_fast(runs, add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, "<u4") for x in coded]) if coded else np.zeros(0, "<u4")
            cut = [0, *(4 * np.searchsorted(np.cumsum(width[ids]), ends, side="right")).tolist()]
            data = ids.tobytes()
            return [data[a:b] for a, b in zip(cut, cut[1:])]

        # A string that the tokenizer takes whole may hold or take in blanks: then texts are not cut at them.
        cut_at_blanks = not any(blank(t.content) or t.lstrip or t.rstrip or t.single_word for t in added.values())
        marks = "".join(m for m in MARKS if not any(m in t.content for t in added.values()))
        _workers[key] = ChunkEncoder(encode, encode_chunks, CHUNKS, marks) if cut_at_blanks else _Whole(encode)
    return _workers[key]


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, piece: int = PIECE, group: int = GROUP) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned
    32-bit bytes), doc_tokens, sequence_id, offset."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([SEPARATOR], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(shared.value)
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        tails: list[tuple] = []                     # (id, start, ids, doc_tokens)
        waiting = 0

        def flush_tails():
            nonlocal sequence, waiting
            for part in pack([len(t[2]) // 4 for t in tails], window) if tails else ():
                at = 0
                for i in part:
                    doc, start, ids, total = tails[i]
                    rows.append((doc, start, len(ids) // 4, ids, total, sequence, at))
                    at += len(ids) // 4
                sequence += 1
            tails.clear()
            waiting = 0

        def out():
            columns = list(zip(*rows)) or [()] * 7
            rows.clear()
            return pa.record_batch([pa.array(columns[0], id_type), *(pa.array(columns[k], t) for k, t in (
                (1, pa.int64()), (2, pa.int64()), (3, pa.binary()), (4, pa.int64()), (5, pa.int64()),
                (6, pa.int64())))], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        id_type = None
        for part in slabs(batches, "text"):
            id_type = part.schema.field("id").type
            texts = part.column("text").fill_null("").to_pylist()
            for doc, ids in zip(part.column("id").to_pylist(), encoder.texts(texts)):
                ids += end
                total = len(ids) // 4
                full = total // window * window
                for start in range(0, full, window):
                    rows.append((doc, start, window, ids[4 * start:4 * (start + window)], total, sequence, 0))
                    sequence += 1
                for start in range(full, total, piece):
                    tails.append((doc, start, ids[4 * start:4 * min(total, start + piece)], total))
                waiting += 1
                if waiting >= group:
                    flush_tails()
            if rows:
                yield out()
        flush_tails()
        if rows:
            yield out()
        pa.default_memory_pool().release_unused()       # the worker may go on with other stages

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                             "sequence_id bigint, offset bigint")
            .withColumnRenamed("id", id_col))

