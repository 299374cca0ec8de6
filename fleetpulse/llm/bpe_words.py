"""Splitting texts for byte-level BPE without running the pattern on every
occurrence of a word.

No match of the pattern runs across a space that follows a non-blank, so a
text cut at its spaces falls into chunks that can be split, and encoded,
once each; Arrow finds the distinct ones of a slab and those met before, so
Python meets new words only. A chunk that is empty or has a blank at either end (a run of
blanks) is outside that rule; texts with such chunks go through the pattern
whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Fixed value: the pattern of the rank files (the public tokenizers package
# states the same), with the blank class written out as a property.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"""
           r"""|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+""")
find = regex.compile(PATTERN).findall
blank_end = regex.compile(r"\A\p{White_Space}|\p{White_Space}\Z").search

MARKS = ".,;:!?"         # marks that close a word
LETTER = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]"      # some that are letters in every Unicode version
BLANK = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"      # White_Space
BLANK_END = rf"\A(?:{BLANK}|\z)|{BLANK}\z"     # or nothing at all
CACHE = 700_000     # entries a worker keeps between slabs; only speed depends on it


class ChunkEncoder:
    """Text -> ids as little-endian unsigned 32-bit bytes. ``encode`` maps a
    list of strings to their id bytes, each string on its own;
    ``encode_chunks`` may do so faster for strings that begin with a space
    and hold no other blank at an end. ``marks``: closing marks that a match
    of the pattern never joins to the letter before them; new chunks are
    encoded without them. ``cache``: chunks remembered, as one Arrow array
    with their ids in one pool; those not met for longest are forgotten."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]],
                 encode_chunks: Callable[[list[str]], list[bytes]] | None = None, cache: int = CACHE,
                 marks: str = MARKS):
        self.encode, self.encode_chunks, self.cache = encode, encode_chunks or encode, cache
        self.marks = dict(zip(marks, encode(list(marks))))
        self.closing = f"({LETTER})[{marks}]$" if marks else r"(a)\z.$"
        self.chunks = pa.array([], pa.large_string())
        self.ids, self.length = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.blank, self.met, self.slab = np.zeros(0, bool), np.zeros(0, np.int64), 0

    def forget(self) -> None:
        """Leaves the half of the cache that was met last."""
        keep = np.zeros(len(self.chunks), bool)
        keep[np.argsort(self.met, kind="stable")[-(self.cache // 2):]] = True
        self.chunks, self.ids = self.chunks.filter(pa.array(keep)), self.ids[np.repeat(keep, self.length)]
        self.length, self.blank, self.met = self.length[keep], self.blank[keep], self.met[keep]

    def places(self, chunks: pa.Array) -> np.ndarray:
        """Where the cache has these distinct chunks, each after a space."""
        if len(self.chunks) > self.cache:
            self.forget()
        self.slab += 1
        at = pc.index_in(chunks, value_set=self.chunks).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        fresh = chunks.filter(pa.array(at < 0))
        blank = pc.match_substring_regex(fresh, BLANK_END).to_numpy(zero_copy_only=False)
        base = pc.replace_substring_regex(fresh, self.closing, r"\1")
        closed = pc.not_equal(base, fresh).to_numpy(zero_copy_only=False)
        coded = base.dictionary_encode()
        bodies = coded.indices.to_numpy()
        wanted = np.zeros(len(coded.dictionary), bool)
        wanted[bodies[~blank]] = True
        found = np.full(len(wanted), b"", object)
        found[wanted] = self.encode_chunks([" " + c for c in
                                            coded.dictionary.filter(pa.array(wanted)).to_numpy(zero_copy_only=False)])
        ids = found[bodies]
        ids[blank] = b""
        ends = pc.utf8_slice_codeunits(fresh.filter(pa.array(closed)), -1).to_pylist()
        ids[closed] += np.array([self.marks[m] for m in ends] + [None], object)[:-1]
        at[at < 0] = len(self.chunks) + np.arange(len(ids))
        self.chunks = pa.concat_arrays([self.chunks, fresh])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
        self.length = np.concatenate([self.length, np.array([len(x) // 4 for x in ids], np.int64)])
        self.blank = np.concatenate([self.blank, blank])
        self.met = np.concatenate([self.met, np.zeros(len(ids), np.int64)])
        self.met[at] = self.slab
        return at

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, whole."""
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        count = pc.list_value_length(cut).to_numpy().astype(np.int64)
        first = np.cumsum(count) - count
        coded = cut.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        # The first chunk has no space before it; texts with other blanks are encoded whole.
        spaced = np.ones(len(at), bool)
        spaced[first] = False
        wanted = np.zeros(len(coded.dictionary), bool)
        wanted[at[spaced]] = True
        place = np.zeros(len(wanted), np.int64)
        place[wanted] = self.places(coded.dictionary.filter(pa.array(wanted)))
        opening = coded.dictionary.take(pa.array(at[first])).to_pylist()
        length, start = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        at = place[at[spaced]]
        length[spaced], start[spaced] = self.length[at], (np.cumsum(self.length) - self.length)[at]
        blank = np.zeros(len(length), bool)
        blank[spaced] = self.blank[at]
        whole = np.logical_or.reduceat(blank, first) | np.array([bool(x and blank_end(x)) for x in opening], bool)
        heads = self.encode([t if w else x for t, x, w in zip(texts, opening, whole.tolist())])
        length[np.repeat(whole, count)] = 0
        length[first] = [len(h) // 4 for h in heads]
        start[first] = len(self.ids) + np.cumsum(length[first]) - length[first]
        pool = np.concatenate([self.ids, np.frombuffer(b"".join(heads), "<u4")])
        done = np.cumsum(length)
        data = pool[np.repeat(start - done + length, length) + np.arange(done[-1])].tobytes()
        ends = (4 * done[first + count - 1]).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]
