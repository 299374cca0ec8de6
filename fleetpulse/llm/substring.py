"""Substring dedup: words covered by a window that occurs more than once go.

Two passes over the texts. The first counts in a count-min sketch, the
second groups exactly only what the sketch calls repeated:

1. Every window of ``k`` words has an anchor: the smallest of its ``GRAM``-word
   grams (the leftmost, if equal). Equal windows have equal anchors at equal
   offsets, so an anchor stands at least as often as any of its windows, and
   counting anchors (about one position in fifteen) overestimates windows.
   Tasks fill sketches, which merge block by block.
2. Windows whose anchor is estimated repeated are grouped exactly by 128 bits
   of hashes, 64 of the anchor and 64 of the window. Each slab of a task groups
   its own windows first: it sends every different window once, and settles
   those that it saw twice by itself, so a very frequent window is sent at most
   once per slab. Windows that follow one another under one anchor travel as
   one row, dealt out by the anchor: its hash, the text's key and a place once,
   then 8 bytes a window. Where they arrive they become rows of their own,
   which Spark sorts; a run of two or more is repeated.
3. Ranges found are gathered by text (keyed by a hash of its words, so copies
   share them) and joined back. Texts whose key a bloom table of the texts with
   ranges does not hold lose nothing and are not shuffled. Copies of one text
   make a key hot; both sides of the join are plain tables, so Spark splits it.

Defined cases: null or empty texts have no words; texts shorter than ``k``
lose nothing; repeated rows count as occurrences of each other; an empty
table gives an empty result. Only named columns are read, results are new
columns beside ``keep``; clashing extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.sketch import RepeatSketch, bits_for, build_repeat_sketch, text_bytes
from fleetpulse.llm.tables import staged, with_fields
from fleetpulse.llm.textcore import BASES, U, Words, sequence_keys, slabs, windows

GRAM = 16
ROOM = 24                       # bits for a position within a slab, the same for all slabs that fit
PART_BYTES = 64 << 20           # of texts whose windows meet in one partition, about


def _sliding_argmin(values: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest value of each ``span``-long slice (the
    leftmost of equals, comparing the hash bits that leave room for the
    position)."""
    n = len(values)
    if n < span:
        return np.zeros(0, np.int64)
    room = U(max(ROOM, int(n).bit_length()))
    low = (values >> room << room) | np.arange(n, dtype=U)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    if rest:
        low = np.minimum(low[:len(low) - rest], low[rest:])
    return (low & ((U(1) << room) - U(1))).astype(np.int64)


def _anchors(words: Words, lane: np.ndarray, k: int, gram: int):
    """(window starts, anchor position of each, gram hashes): of windows that
    lie within one text."""
    n = len(lane)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    grams = windows(lane, gram, BASES[1])
    at = _sliding_argmin(grams, k - gram + 1)
    ends = np.repeat(words.first[1:], words.count)
    start = np.flatnonzero(np.arange(n - k + 1) + k <= ends[:n - k + 1])
    return start, at[start], grams


def repeat_ranges(docs: DataFrame, text_col: str, k: int) -> DataFrame:
    """(doc, lo, hi): word ranges to remove, ``doc`` a text's word-sequence key."""
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    gram = min(GRAM, k)
    size = text_bytes(texts, "text")
    bits = bits_for(size // 60)          # about one anchor in 60 bytes

    def anchors_of(batch: pa.RecordBatch) -> np.ndarray:
        found = []
        for part in slabs([batch], "text"):
            words = Words(part.column("text"))
            _, at, grams = _anchors(words, words.lane(0), k, gram)
            found.append(grams[np.unique(at)])
        return np.concatenate(found) if found else np.zeros(0, U)

    sketch = texts.sparkSession.sparkContext.broadcast(build_repeat_sketch(texts, anchors_of, bits))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = RepeatSketch(bits, sketch.value)
        for part in slabs(batches, "text"):
            words = Words(part.column("text"))
            lanes = [words.lane(0), words.lane(1)]
            start, at, grams = _anchors(words, lanes[0], k, gram)
            if not len(start):
                continue
            anchor, inverse = np.unique(at, return_inverse=True)
            some = counts.repeated(grams[anchor])[inverse]
            start, at = start[some], at[some]
            if not len(start):
                continue
            h1 = windows(lanes[0], k, BASES[0])[start].view(np.int64)
            h2 = windows(lanes[1], k, BASES[1])[start].view(np.int64)
            order = np.lexsort((start, h2, h1))
            new = np.ones(len(start), bool)
            new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
            group = np.cumsum(new) - 1
            twice = np.empty(len(start), bool)
            twice[order] = np.bincount(group)[group] > 1
            keys = sequence_keys(lanes, words.first)
            text = np.searchsorted(words.first, start, side="right") - 1
            # Every different window once, in the order of the text; those seen twice here are only announced.
            one = np.sort(order[new])
            begins = np.ones(len(one), bool)
            begins[1:] = ((np.diff(start[one]) != 1) | (np.diff(at[one]) != 0) | (np.diff(text[one]) != 0)
                          | (twice[one][1:] != twice[one][:-1]))
            edge = np.append(np.flatnonzero(begins), len(one))
            row = one[edge[:-1]]
            lo = start[row] - words.first[text[row]]
            yield pa.record_batch([
                pa.array(grams[at[row]].view(np.int64)),
                pa.array([None if s else keys[t] for s, t in zip(twice[row].tolist(), text[row].tolist())], pa.binary()),
                pa.array(lo, pa.int32()), pa.array(lo + np.diff(edge) - 1 + k, pa.int32()),
                pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(h2[one]))],
                names=["anchor", "doc", "lo", "hi", "windows"])
            # Ranges of the windows settled here.
            begin = start[twice]
            if len(begin):
                owner = np.searchsorted(words.first, begin, side="right") - 1
                gap = np.ones(len(begin), bool)
                gap[1:] = (np.diff(begin) > k) | (np.diff(owner) > 0)
                last = np.append(np.flatnonzero(gap)[1:], len(begin)) - 1
                owner, first = owner[gap], begin[gap]
                ranges = sorted({(keys[t], int(a - words.first[t]), int(b + k - words.first[t]))
                                 for t, a, b in zip(owner.tolist(), first.tolist(), begin[last].tolist())})
                doc = [r[0] for r in ranges]
                key = np.frombuffer(b"".join(doc), np.int64).reshape(-1, 2)
                yield pa.record_batch([
                    pa.array(key[:, 0]), pa.array(doc, pa.binary()),
                    pa.array([r[1] for r in ranges], pa.int32()), pa.array([r[2] for r in ranges], pa.int32()),
                    pa.nulls(len(doc), pa.list_(pa.int64()))], names=["anchor", "doc", "lo", "hi", "windows"])

    def joined(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        """Ranges of a text that touch or overlap become one."""
        rows = pa.Table.from_batches(rows)
        key = np.frombuffer(b"".join(rows.column("doc").to_pylist()), np.int64).reshape(-1, 2)
        lo, hi = rows.column("lo").to_numpy(), rows.column("hi").to_numpy()
        order = np.lexsort((lo, key[:, 1], key[:, 0]))
        key, lo, hi = key[order], lo[order], hi[order]
        gap = np.ones(len(lo), bool)
        gap[1:] = (np.diff(key, axis=0) != 0).any(axis=1) | (np.diff(lo) > k)        # all are windows of k words
        last = np.append(np.flatnonzero(gap)[1:], len(lo)) - 1
        return pa.record_batch([pa.array([x.tobytes() for x in key[gap]], pa.binary()), pa.array(lo[gap]),
                                pa.array(hi[last])], names=["doc", "lo", "hi"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None             # (anchor, h) of the window read last
        proven = False          # it is known to be repeated
        held = None             # its row, while it stands alone
        for batch in batches:
            if not batch.num_rows:
                continue
            done = batch.filter(batch.column("h").is_null()).select(["doc", "lo", "hi"])
            if done.num_rows:
                yield done
            rows = batch.filter(batch.column("h").is_valid())
            if not rows.num_rows:
                continue
            anchor, h = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "h"))
            settled = rows.column("doc").is_null().to_numpy(zero_copy_only=False)
            new = np.ones(len(h), bool)
            new[1:] = (np.diff(anchor) != 0) | (np.diff(h) != 0)
            follows = last == (anchor[0], h[0])
            group = np.cumsum(new) - 1
            size, proof = np.bincount(group), np.bincount(group, settled) > 0
            if follows:
                size[0] += 1
                proof[0] |= proven
            repeated = (size > 1) | proof
            out = [held] if follows and held is not None else []
            held = None
            take = repeated[group] & ~settled
            if not repeated[-1]:
                held = rows.slice(len(h) - 1, 1).select(["doc", "lo", "hi"])
            last, proven = (anchor[-1], h[-1]), bool(repeated[-1])
            if take.any():
                out.append(rows.filter(pa.array(take)).select(["doc", "lo", "hi"]))
            if out:
                yield joined(out)

    spark = texts.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    packed = texts.mapInArrow(candidates, "anchor bigint, doc binary, lo int, hi int, windows array<bigint>")
    # A row for every window; without a hash, one for every range settled before.
    at = F.col("lo") + F.coalesce("place", F.lit(0))
    return (packed.repartition(parts, "anchor")
            .select("anchor", "doc", "lo", "hi", F.posexplode_outer("windows").alias("place", "h"))
            .select("anchor", "h", "doc", at.alias("lo"), F.when(F.col("h").isNull(), F.col("hi")).otherwise(at + k).alias("hi"))
            .sortWithinPartitions("anchor", "h", "doc", "lo").mapInArrow(settle, "doc binary, lo int, hi int"))


def remove_repeats(docs: DataFrame, keep: list[str], text_col: str = "text", k: int = 35) -> DataFrame:
    """``keep`` columns (as struct ``row``) with ``text`` (as given), ``kept``
    (remaining words joined by one space), ``n_words`` and ``n_removed``."""
    ranges = staged(repeat_ranges(docs, text_col, k).groupBy("doc")
                    .agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")), "repeat-ranges")
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).cast("string").alias("text"))
    bits = bits_for(ranges.count(), 0.1)
    head = lambda keys: np.frombuffer(b"".join(key[:8] for key in keys), U)
    asked = docs.sparkSession.sparkContext.broadcast(
        build_repeat_sketch(ranges.select("doc"), lambda batch: head(batch.column("doc").to_pylist()), bits))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray]]:
        """Slabs with the keys of their texts and whether these may have ranges."""
        table = RepeatSketch(bits, asked.value)
        for part in slabs(batches, "text", 1 << 20):
            words = Words(part.column("text"))
            keys = sequence_keys([words.lane(0), words.lane(1)], words.first)
            yield part, keys, table.contains(head(keys))

    def travelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, may in keyed(batches):
            yield pa.record_batch([*part.columns, pa.array(keys, pa.binary())],
                                  names=["row", "text", "doc"]).filter(pa.array(may))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, may in keyed(batches):
            part = part.filter(pa.array(~may))
            yield shortened(part, [None] * part.num_rows)

    def shortened(part: pa.RecordBatch, ranges: list) -> pa.RecordBatch:
        kept, total, removed = [], [], []
        for text, found in zip(part.column("text").to_pylist(), ranges):
            words = (text or "").encode().split()
            gone = 0
            if found:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [r["lo"] for r in found], 1)
                np.add.at(edge, [r["hi"] for r in found], -1)
                stays = np.cumsum(edge[:-1]) == 0
                gone = len(words) - int(stays.sum())
                out = [words[i] for i in np.flatnonzero(stays).tolist()]
            else:
                out = words
            kept.append(b" ".join(out).decode("utf-8", "replace"))
            total.append(len(words))
            removed.append(gone)
        return pa.record_batch([part.column("row"), part.column("text"), pa.array(kept, pa.string()),
                                pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                               names=["row", "text", "kept", "n_words", "n_removed"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, "text"):
            yield shortened(part, part.column("ranges").to_pylist())

    schema = with_fields(rows, "row", "text string, kept string, n_words bigint, n_removed bigint")
    return (rows.mapInArrow(travelling, with_fields(rows, "row", "text string, doc binary"))
            .join(ranges, "doc", "left").select("row", "text", "ranges").mapInArrow(cut, schema)
            .union(rows.mapInArrow(whole, schema)))
