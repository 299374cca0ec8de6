"""Phrase collocation mining: frequent phrases of two to ``LONGEST`` words and
how much more often than chance their parts meet, per language.

Layout of an external stream estimation. One stream of padded windows (a
position's next words) is sorted in prefix order; a scan over the sorted
windows closes a run whenever the first k words change, which counts the
phrases of every length at once, without a hash table. The counts are kept as
a table; every cut of a phrase looks up its left part in prefix order and its
right part in suffix order by merge joins of sorted streams, and the phrase's
own count travels with the cut, so the same two streams tell the extensions of
a part: a phrase is dropped when one word more, on either side, is as frequent.
(A longer phrase that is as frequent has all phrases in between as frequent.)

Windows are cut before the first pair of words that cannot be frequent. Two
bit tables say which: words, then pairs, whose exact count over all documents
reaches the least one. A table has at most 32 MB; where more values than fit
pass, more windows travel, and counts stay exact, as a scan only ever
counts whole runs.

Skew: windows are counted within a slab before they are sent; ranges are dealt
by the whole window, so a frequent first word is spread over tasks; a run that
crosses a boundary is sent as parts and summed.

Defined cases: null texts are empty, null languages ``und``; texts of any
length are read whole, in slabs of about ``SLAB`` bytes; repeated rows count
each; ties in score go to the greater count, then the phrase's bytes; an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from fleetpulse.llm.sketch import RepeatSketch, bits_for, build_repeat_sketch
from fleetpulse.llm.tables import staged
from fleetpulse.llm.textcore import _LOWER, BASES, MIX2, PIECE, U, mix, slices_hash

LONGEST = 5             # words in a phrase
LEAST = 100             # occurrences of a phrase
TOP = 2000              # phrases told for a language
SLAB = 8 << 20
PARTS = 64              # parts of a language whose first phrases are sought apart

# Bytes between words, and bytes that end a piece of text.
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_END = np.zeros(256, bool)
_END[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Slab:
    """The words of some texts, back to back with one space after each:
    ``raw[start[i]:end[i]]`` is word i, ``lang[i]`` its language's number,
    ``ends[i]`` the first word after its piece."""

    def __init__(self, texts: pa.Array, langs: np.ndarray):
        col = texts.cast(pa.large_string()).fill_null("")
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        data = col.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        raw = raw[off[0]:off[-1]] if len(off) else raw[:0]
        off = off - off[0]
        if not len(raw):
            self.raw = raw
            self.start = self.end = self.ends = np.zeros(0, np.int64)
            self.lang = np.zeros(0, np.int64)
            return
        raw = _LOWER[raw]
        end = _END[raw]
        out = _GAP[raw] | end
        begins = np.zeros(len(raw) + 1, bool)
        begins[off] = True
        start = np.flatnonzero(~out & (np.concatenate([[True], out[:-1]]) | begins[:-1]))
        stop = np.flatnonzero(~out & (np.concatenate([out[1:], [True]]) | begins[1:])) + 1
        # Words of one piece have met as many piece ends, and as many texts.
        met = np.cumsum(end)[start] + np.searchsorted(off, start, side="right") if len(start) else start
        size = stop - start
        self.start = np.concatenate([[0], np.cumsum(size + 1)[:-1]]) if len(size) else size
        self.end = self.start + size
        total = int(self.end[-1]) + 1 if len(size) else 0
        self.raw = np.full(total, 32, np.uint8)
        self.raw[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = \
            raw[np.arange(int(size.sum())) + np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)] \
            if len(size) else raw[:0]
        last = np.flatnonzero(np.concatenate([met[1:] != met[:-1], [True]])) if len(met) else met
        self.ends = np.repeat(last + 1, np.diff(np.concatenate([[-1], last]))) if len(met) else met
        self.lang = langs[np.searchsorted(off, start, side="right") - 1] if len(start) else start

    def hashes(self, salts: np.ndarray, base: int = 0) -> np.ndarray:
        """One hash per word, of its bytes and its language."""
        out, i = np.empty(len(self.start), U), 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.start, self.start[i] + PIECE)))
            lo = self.start[i]
            out[i:j] = slices_hash(self.raw[lo:self.end[j - 1]].astype(U) + U(1), self.start[i:j] - lo,
                                   self.end[i:j] - lo, BASES[base])
            i = j
        return mix(out + salts[self.lang]) if len(out) else out

    def slices(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        """``raw[start:end]`` of every pair as strings."""
        size = end - start
        off = np.concatenate([[0], np.cumsum(size)])
        data = self.raw[np.arange(off[-1]) + np.repeat(start - off[:-1], size)]
        return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(off.astype("<i8")), pa.py_buffer(data)) \
            .cast(pa.string())


def _salts(names: list[str]) -> np.ndarray:
    """A number for every language, which its words' hashes carry."""
    return np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in names], U)


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Slab, np.ndarray, list[str]]]:
    """(slab, one salt per language, language names) of texts gathered to
    about ``SLAB`` bytes; a longer text is a slab of its own."""
    texts: list[pa.Array] = []
    langs: list[pa.Array] = []
    held = 0

    def close():
        names = pa.chunked_array(langs).combine_chunks().dictionary_encode()
        names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
        known = names.dictionary.to_pylist()
        salts = _salts(known)
        slab = Slab(pa.concat_arrays(texts), names.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        texts.clear(), langs.clear()
        return slab, salts, known

    for batch in batches:
        text = batch.column("text").fill_null("")
        size = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = int(size[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(size, done + SLAB - held, side="right")))
            texts.append(text.slice(at, to - at))
            langs.append(batch.column("lang").slice(at, to - at))
            held += int(size[to - 1]) - done
            at = to
            if held >= SLAB or at < batch.num_rows:
                yield close()
                held = 0
    if texts:
        yield close()


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a position of every different key, how often it stands)."""
    _, at, n = np.unique(keys, return_index=True, return_counts=True)
    return at, n


def _pairs(slab: Slab, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions whose next word is in the same piece, hash of the two)."""
    at = np.flatnonzero(slab.ends > np.arange(len(lane)) + 1)
    return at, mix(lane[at] * U(BASES[1]) + lane[at + 1] + MIX2)


def _batch(slab: Slab, known: list[str], at: np.ndarray, words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(known, pa.string()).take(pa.array(slab.lang[at])),
                            slab.slices(slab.start[at], slab.end[at + words - 1]), pa.array(n, pa.int64())],
                           names=["lang", "phrase", "n"])


def texts_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, n) of every single word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, salts, known in _slabs(batches):
            if len(slab.start):
                at, n = _grouped(slab.hashes(salts))
                yield _batch(slab, known, at, np.ones(len(at), np.int64), n)

    return texts.mapInArrow(count, "lang string, phrase string, n long") \
        .groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _word_hashes(batch: pa.RecordBatch) -> np.ndarray:
    known = pc.unique(batch.column("lang"))
    number = pc.index_in(batch.column("lang"), known).to_numpy(zero_copy_only=False)
    out = np.empty(batch.num_rows, U)
    raw = batch.column("phrase").cast(pa.large_string())
    off = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] is not None else np.zeros(0, np.uint8)
    for i in range(0, batch.num_rows, 1 << 16):
        j = min(batch.num_rows, i + (1 << 16))
        lo = off[i]
        out[i:j] = slices_hash(data[lo:off[j]].astype(U) + U(1), off[i:j] - lo, off[i + 1:j + 1] - lo, BASES[0])
    salts = _salts(known.to_pylist())
    return mix(out + salts[number]) if len(out) else out


def frequent_windows(texts: DataFrame, words: DataFrame, least: int, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, n): for each position whose first pair of words may be
    frequent, its next words up to the first pair that is not; equal windows
    of a slab are one row."""
    spark = texts.sparkSession
    bits_w = bits_for(words.count())
    table_w = spark.sparkContext.broadcast(build_repeat_sketch(words.select("lang", "phrase"), _word_hashes, bits_w))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = RepeatSketch(bits_w, table_w.value)
        for slab, salts, _ in _slabs(batches):
            lane = slab.hashes(salts)
            common = may.contains(lane)
            at, key = _pairs(slab, lane)
            key, n = np.unique(key[common[at] & common[at + 1]], return_counts=True)
            for i in range(0, len(key), 1 << 16):
                yield pa.record_batch([pa.array(key[i:i + (1 << 16)].view(np.int64)), pa.array(n[i:i + (1 << 16)])],
                                      names=["key", "n"])

    often = staged(texts.mapInArrow(pairs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
                   .where(F.col("n") >= least).select("key"), "pairs")
    bits_p = bits_for(often.count())
    table_p = spark.sparkContext.broadcast(build_repeat_sketch(
        often, lambda b: b.column("key").to_numpy(zero_copy_only=False).view(U), bits_p))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = RepeatSketch(bits_p, table_p.value)
        for slab, salts, known in _slabs(batches):
            lane = slab.hashes(salts)
            at, key = _pairs(slab, lane)
            good = np.zeros(len(lane) + longest, bool)
            good[at[may.contains(key)]] = True              # the pair that starts here may be frequent
            first = np.flatnonzero(good[:len(lane)])
            size = np.ones(len(first), np.int64)
            whole = lane[first]
            going = np.ones(len(first), bool)
            for k in range(1, longest):
                going &= good[first + k - 1]
                size += going
                step = mix(whole * U(BASES[1]) + lane[np.minimum(first + k, len(lane) - 1)] + MIX2)
                whole = np.where(going, step, whole)
            pick, n = _grouped(mix(whole + size.astype(U)))
            for i in range(0, len(pick), 1 << 16):
                part = pick[i:i + (1 << 16)]
                yield _batch(slab, known, first[part], size[part], n[i:i + (1 << 16)])

    return texts.mapInArrow(windows, "lang string, phrase string, n long")


def prefix_counts(windows: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of every phrase of two words or more that stands
    ``least`` times: run lengths over the windows in prefix order."""
    # With a space after the last word, windows that begin with the same words lie together in byte order.
    ordered = windows.select("lang", F.concat("phrase", F.lit(" ")).alias("phrase"), "n") \
        .repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, before = None, []
        runs: list[int] = []                # of the first 1, 2, ... words of the row before
        at_edge = 0                         # so many of them began with the partition: their count is a part
        out: list[tuple[str, str, int]] = []

        def close(keep: int, last: bool = False):
            nonlocal at_edge
            for k in range(len(runs), keep, -1):
                n = runs.pop()
                if k > 1 and (n >= least or k <= at_edge or last):
                    out.append((lang, " ".join(before[:k]), n))
            at_edge = min(at_edge, keep)

        def flush():
            got = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64()))],
                                  names=["lang", "phrase", "n"])
            out.clear()
            return got

        for batch in batches:
            for name, text, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase", "n"))):
                words = text[:-1].split(" ")
                same = 0
                if name == lang:
                    for a, b in zip(before, words):
                        if a != b:
                            break
                        same += 1
                close(same)
                if lang is None:
                    at_edge = len(words)
                for k in range(same):
                    runs[k] += n
                runs += [n] * (len(words) - same)
                lang, before = name, words
            if len(out) >= 4096:
                yield flush()
        close(0, last=True)
        if out:
            yield flush()

    return ordered.mapInArrow(scan, "lang string, phrase string, n long") \
        .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases that no longer one
    is as frequent as. ``counts``: (lang, phrase, words, n) of frequent words
    and phrases; ``totals``: (lang, total)."""
    cuts = counts.where("words > 1").select(
        "lang", "phrase", F.col("n").alias("a"), "words", F.split("phrase", " ").alias("w"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")) \
        .select("lang", "phrase", "a", "words", "k",
                F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ").alias("right"))
    stream = lambda part, n: counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(n)).hint("merge")
    both = cuts.join(stream("left", "l"), ["lang", "left"]).join(stream("right", "r"), ["lang", "right"])
    # What lacks one word at an end, with the greatest count of what extends it so.
    inner = cuts.where("k = 1").select("lang", F.col("right").alias("phrase"), "a").union(
        cuts.where("k = words - 1").select("lang", F.col("left").alias("phrase"), "a"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = lambda c: f"cast({c} as decimal(38, 0))"         # products pass 64 bits
    valued = both.join(totals, "lang").withColumn(
        "score", F.expr(f"(1000 * {wide('a')} * {wide('total')}) div ({wide('l')} * {wide('r')})"))
    lowest = valued.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", F.col("total").alias("n"))).alias("cut"))
    return lowest.join(longer.hint("merge"), ["lang", "phrase"], "left").where("longer is null or longer < cut.a") \
        .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text",
         lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase worth telling."""
    texts = texts_of(docs, text_col, lang_col)
    words = staged(word_counts(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    common = words.where(F.col("n") >= least)
    windows = staged(frequent_windows(texts, common, least, longest), "windows")
    counts = staged(common.union(prefix_counts(windows, least)).withColumn("words", F.size(F.split("phrase", " "))),
                    "counts")
    return scored(counts, totals)


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` by score, count and phrase: first of
    every part of a language, so that no task sorts a whole language."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    heads = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))) \
        .withColumn("rank", place("lang", "part")).where(F.col("rank") <= top)
    return heads.withColumn("rank", place("lang")).where(F.col("rank") <= top) \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = f"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
               FROM documents),
         w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
         g AS (SELECT lang, k.k, array_to_string(list_slice(w, i.i, i.i + k.k - 1), ' ') AS phrase
               FROM w, range(1, {LONGEST + 1}) AS k(k), unnest(range(1, len(w) - k.k + 2)) AS i(i)),
         c AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL),
         t AS (SELECT lang, sum(n)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
         f AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND n >= {LEAST}),
         u AS (SELECT f.lang, f.phrase, f.a, j.j, l.n AS l, r.n AS r, t.n,
                      ((1000::HUGEINT * f.a * t.n) // (l.n::HUGEINT * r.n))::BIGINT AS score
               FROM f, unnest(range(1, f.k)) AS j(j)
               JOIN c l ON l.lang = f.lang AND l.phrase = array_to_string(f.w[1:j.j], ' ')
               JOIN c r ON r.lang = f.lang AND r.phrase = array_to_string(f.w[j.j + 1:f.k], ' ')
               JOIN t ON t.lang = f.lang),
         b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
         s AS (SELECT * FROM b WHERE NOT EXISTS (
                   SELECT 1 FROM f WHERE f.lang = b.lang AND f.a >= b.a AND length(f.phrase) > length(b.phrase)
                          AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' '))),
         o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s)
    SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= {TOP}"""
