"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words (pattern matches) of a slab of texts form one flat array
of tokens. An inverted index leads from the rank of a token pair to the
positions where the pair stands; ranks are replayed in order, each over all
its positions at once, and a merge updates the index for its two neighbours
only. A merge may create a pair of a lower rank; the replay then steps back
to that rank before it goes on, which keeps every word's merges in the order
a word-at-a-time encoder takes.

Words are independent of one another, so each task replays the merges over
the distinct words of its own slabs (bounded bytes) and keeps what it
learned; nothing is shuffled.

Defined cases: a null or empty text has no ids; duplicate rows and null ids
are encoded row by row; an empty table gives an empty result. Only the
named columns are read, so extra columns of any name do not matter.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.bpe_words import CACHE, ChunkEncoder, find
from fleetpulse.llm.textcore import slabs


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token -> rank, from the lines of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class MergeReplay:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        self.known: dict[int, int] = {}                 # pair of ids -> rank, -1 if it has none
        self.bytes_rank = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        self.words: dict[str, bytes] = {}

    def pair(self, a: int, b: int) -> int:
        r = self.known[a << 32 | b] = self.ranks.get(self.token[a] + self.token[b], -1)
        return r

    def __call__(self, strings: list[str]) -> list[bytes]:
        """Ids of each string, as little-endian unsigned 32-bit bytes."""
        if len(self.words) > CACHE // 2:
            self.words.clear()
        if len(self.known) > 4 * CACHE:
            self.known.clear()
        split = [find(s) for s in strings]
        new = list({w for x in split for w in x}.difference(self.words))
        self.words.update(zip(new, self.replay([w.encode() for w in new])))
        ids = self.words
        return [ids[x[0]] if len(x) == 1 else b"".join([ids[w] for w in x]) for x in split]

    def replay(self, words: list[bytes]) -> list[bytes]:
        sizes = np.array([len(w) for w in words], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        if not n:
            return [b""] * len(words)
        first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        first[bounds] = True
        last[bounds[1:] - 1] = True
        first, last = first[:n], last[:n]
        here = np.arange(n)
        after = np.where(last, -1, here + 1).tolist()
        before = np.where(first, -1, here - 1).tolist()
        ranked = np.where(last, -1, self.bytes_rank[raw, np.append(raw[1:], 0)])
        # The inverted index: rank of a pair -> positions of its left token.
        order = np.argsort(ranked, kind="stable")
        values, starts = np.unique(ranked[order], return_index=True)
        places = {int(v): x.tolist() for v, x in zip(values, np.split(order, starts[1:])) if v >= 0}
        token, rank = self.single[raw].tolist(), ranked.tolist()
        known, pair = self.known, self.pair
        heap = list(places)                              # rising, so a heap already
        while heap:
            r = heapq.heappop(heap)
            at = places.pop(r)
            at.sort()
            for k, i in enumerate(at):
                if rank[i] != r:
                    continue                             # a neighbour merged first
                j = after[i]
                right = after[j]
                token[i], token[j], rank[j] = r, -1, -1
                after[i] = right
                lower = False
                if right < 0:
                    rank[i] = -1
                else:
                    before[right] = i
                    new = known.get(r << 32 | token[right])
                    if new is None:
                        new = pair(r, token[right])
                    rank[i] = new
                    if new >= 0:
                        if new in places:
                            places[new].append(i)
                        else:
                            places[new] = [i]
                            heapq.heappush(heap, new)
                            lower = new < r
                left = before[i]
                if left >= 0:
                    new = known.get(token[left] << 32 | r)
                    if new is None:
                        new = pair(token[left], r)
                    rank[left] = new
                    if new >= 0:
                        if new in places:
                            places[new].append(left)
                        else:
                            places[new] = [left]
                            heapq.heappush(heap, new)
                            lower |= new < r
                if lower and k + 1 < len(at):            # step back, then return to the rest
                    places.setdefault(r, []).extend(at[k + 1:])
                    heapq.heappush(heap, r)
                    break
        kept = np.asarray(token)
        ends = (np.concatenate([[0], np.cumsum(kept >= 0)])[bounds] * 4).tolist()
        data = kept[kept >= 0].astype("<u4").tobytes()
        whole = self.ranks.get                           # a word that is a token is that token
        return [data[a:b] if b - a == 4 or (t := whole(w)) is None else t.to_bytes(4, "little")
                for w, a, b in zip(words, ends, ends[1:])]


_workers: dict[int, tuple[ChunkEncoder, list[bytes]]] = {}


def _worker(data: bytes) -> tuple[ChunkEncoder, list[bytes]]:
    key = hash(data)
    if key not in _workers:
        ranks = read_ranks(data)
        vocabulary = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            vocabulary[r] = token
        _workers[key] = ChunkEncoder(MergeReplay(ranks)), vocabulary
    return _workers[key]


def encode_decode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): ids as little-endian unsigned 32-bit bytes, and
    the bytes those ids decode to. ``ranks_path`` is read on the driver (a
    vocabulary file of about a megabyte) and broadcast."""
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, vocabulary = _worker(shared.value)
        for part in slabs(batches, "text"):
            ids = encoder.texts(part.column("text").fill_null("").to_pylist())
            decoded = [b"".join([vocabulary[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in ids]
            yield pa.record_batch([part.column("id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                                  names=["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, ids binary, decoded binary")
            .withColumnRenamed("id", id_col))
