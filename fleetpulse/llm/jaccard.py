"""Jaccard join of documents on word shingles, size-aware: heavy and light.

Two sets link when 100 * |A & B| >= percent * |A | B|. Width of the shingles
and percent are a ``Rule``; whatever follows is derived from it, and the
numbers below are those of three words and 90 percent. The boundary between
light (small) and heavy (large) sets is the size with the least estimated cost
over the corpus' size histogram.

* Light sets enumerate subsets. With S = A & B, |S| = m, and i, j the
  elements that A and B have besides, the condition is 9 * (i + j) <= m. So
  every set emits its subsets with i <= m / 9 elements left out, and the sets
  that meet in S link exactly when i + j <= m / 9: linking each to the member
  with the smallest i gives the same components as all pairs, without pairs
  and without looking at the sets again.
* Heavy sets (and light ones near the boundary) scan inverted lists. A list
  belongs to a shingle; a set of n shingles stands in the lists of its
  n // 10 + 1 rarest ones, so linked sets meet in one at least. Rarity is a
  count-min estimate over all documents (any order common to all sets gives
  right results, a good one gives short lists), taken as it is: where shingles
  outnumber the counters, all counts lie near their mean, and only whole counts
  tell a shingle of one document from one that stands in ten. A list pairs sets of fitting
  sizes whose parity sketches allow the link: a sketch holds, for each of its
  cells, whether an odd number of elements falls there, so two sketches differ
  in no more cells than the sets differ in elements, which for linked sets are
  (a + b) / 19 at most. What passes is verified on the whole sets. A long
  list is dealt in blocks by size class and hash; blocks of one class or
  neighbouring ones meet in pairs, each pair a group of its own.

Copies: equal sets share one key, and everything is keyed by it. Near copies
in thousands would make thousands of pairs for each; only components are
asked for, so pairs within one are never needed. Leaders come first: sets that share two min-hashes are compared
with at most ``LEADERS`` leaders, within a slab of a task and then between
slabs, and the links found are united. Then every row of a list proposes its
``NEAREST`` partners of other components, a number of pairs that follows the
lists' rows, and what links is united. A list in which every row could propose
all its partners is settled by then. At last the other lists pair all sets that
are still of different components, so no link between them is lost and no group
is expanded into its pairs.

Defined cases: null or empty texts have no shingles and link with nothing;
texts under a shingle's words have one, the whole sequence; repeated rows
are one set (and one component); null ids sort first in no component and
keep null; empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.sketch import RepeatSketch, bits_for, build_counts, build_repeat_sketch, text_bytes
from fleetpulse.llm.tables import components, staged, staged_texts
from fleetpulse.llm.textcore import BASES, U, Words, mix, slabs, slices_hash, windows

SIZE_CLASS = 1.25        # sizes in this ratio are one class when leaders are sought; the second min-hash's are shifted by half
LEADERS = 64             # sets that a min-hash group compares with at most
ENOUGH = 3               # links after which a set looks for no further leader
MAX_LIGHT = 29           # largest size for which subsets may be enumerated
COUNT_BITS = 22          # at most so many bits of counters for rarity
SKETCH = 1024            # cells of a parity sketch
NEAREST = 2              # partners that a row of a list proposes at first
FLUSH = 1 << 16          # pairs that a task holds at most before it passes them on
MOST_APART, MOST_CELLS = 63, 1 << 16  # sets that may differ in more elements have a cell for each, up to a bound
LIST_BLOCK = 1024        # rows of a list that are compared at a time
LIST_ROWS = 4096         # a list of more rows is dealt in blocks of about so many, which meet in pairs
# Salts of the two min-hashes and of the set key's lanes.
SALTS = (U(0x243F6A8885A308D3), U(0x13198A2E03707344), U(0xA4093822299F31D0), U(0x082EFA98EC4E6C89))


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the least percentage of the union in common."""
    width: int = 3
    percent: int = 90

    def fits(self, n, m):
        """Whether the size ``n`` is near enough to a larger one (or arrays of them)."""
        return 100 * n >= self.percent * m

    def depth(self, n: int) -> int:
        """Elements that a set of ``n`` may have beside another's."""
        return (100 - self.percent) * n // 100

    def may_differ(self, apart, total):
        """Whether sets of ``total`` elements in all may differ in ``apart`` of them."""
        return (100 + self.percent) * apart <= (100 - self.percent) * total


RULE = Rule()


def linked(a: np.ndarray, b: np.ndarray, rule: Rule = RULE) -> bool:
    """The condition on two sorted sets."""
    if not len(a) or not rule.fits(min(len(a), len(b)), max(len(a), len(b))):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= rule.percent * (len(a) + len(b) - both)


def set_key(values: np.ndarray) -> bytes:
    return np.array([mix(values ^ SALTS[2]).sum(dtype=U), np.bitwise_xor.reduce(mix(values ^ SALTS[3])) if len(values)
                     else 0], U).tobytes()


def sets_of(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words = Words(texts, lower=True)
    lane = words.lane(0)
    grams = windows(lane, width, BASES[1])
    short = slices_hash(lane, words.first[:-1], words.first[1:], BASES[1]) if len(words.count) else lane
    out = []
    for d, (lo, hi) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
        out.append(np.unique(grams[lo:hi - width + 1]) if hi - lo >= width
                   else short[d:d + 1] if hi > lo else lane[:0])
    return out


def distinct_sets(part: pa.RecordBatch, width: int, keep: np.ndarray | None = None) -> dict[bytes, np.ndarray]:
    """The sets of a slab by their key, of the rows told by ``keep`` only."""
    at = {k: i for i, k in enumerate(part.column("s").to_pylist()) if keep is None or keep[i]}
    if not at:
        return {}
    return dict(zip(at, sets_of(part.column("text").take(pa.array(list(at.values()))), width)))


def min_hash(values: np.ndarray, k: int) -> int:
    """One hash of the two smallest and the size class: most linked sets
    agree in it for one ``k`` at least, sets that share a passage seldom do."""
    h = mix(values ^ SALTS[k])
    low = np.partition(h, 1)[:2] if len(h) > 1 else h[[0, 0]]
    size = int(np.log(len(h)) / np.log(SIZE_CLASS) + k / 2)
    return int((mix(low[:1] + U(size)) ^ low[1:])[0])


def parity(values: np.ndarray, rule: Rule = RULE) -> bytes:
    wide = rule.may_differ(MOST_APART, 2 * len(values))
    cells = max(SKETCH, min(MOST_CELLS, 1 << (len(values) - 1).bit_length())) if wide else SKETCH
    at = (mix(values ^ SALTS[2]) & U(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8)).tobytes()


def folded(sketch: bytes, size: int = SKETCH // 8) -> np.ndarray:
    """A sketch in ``size`` bytes; a wide one's cells meet by their remainder."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size))


def differing(x: bytes, y: bytes) -> int:
    """Cells in which two sketches differ."""
    if len(x) != len(y):
        size = min(len(x), len(y))
        x, y = folded(x, size).tobytes(), folded(y, size).tobytes()
    return (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()


def may_link(x: bytes, y: bytes, total: int, rule: Rule = RULE) -> bool:
    """Whether sets with these sketches and ``total`` elements may be linked."""
    return rule.may_differ(differing(x, y), total)


def subset_rows(n: int, rule: Rule = RULE) -> int:
    return sum(comb(n, i) for i in range(rule.depth(n) + 1))


def boundary(sizes: dict[int, int], rule: Rule = RULE) -> int:
    """Largest light size: subsets cost their rows; a heavy set costs its
    places in lists, each of which may lead to a check of the whole set."""
    costs = []
    for x in range(MAX_LIGHT + 1):
        light = sum(c * subset_rows(n, rule) for n, c in sizes.items() if n <= x)
        heavy = sum(c * (rule.depth(n) + 1) * (n + 1) for n, c in sizes.items() if x < n <= MAX_LIGHT)
        costs.append(light + heavy)
    return int(np.argmin(costs))


def _light_rows(docs: DataFrame, largest: int, rule: Rule) -> DataFrame:
    """(k1, k2, m, extra, s): subsets of sets of at most ``largest``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import combinations
        for part in slabs(batches, "text"):
            k1, k2, m, extra, own = [], [], [], [], []
            for key, values in distinct_sets(part, rule.width).items():
                n = len(values)
                a, b = mix(values ^ SALTS[2]), mix(values ^ SALTS[3])
                for i in range(rule.depth(n) + 1):
                    left_out = np.array(list(combinations(range(n), i)), np.int64).reshape(comb(n, i), i)
                    k1.append(a.sum(dtype=U) - a[left_out].sum(axis=1, dtype=U))
                    k2.append(np.bitwise_xor.reduce(b) ^ np.bitwise_xor.reduce(b[left_out], axis=1))
                    m += [n - i] * len(left_out)
                    extra += [i] * len(left_out)
                    own += [key] * len(left_out)
            if own:
                yield pa.record_batch([pa.array(np.concatenate(k1).view(np.int64)),
                                       pa.array(np.concatenate(k2).view(np.int64)), pa.array(m, pa.int32()),
                                       pa.array(extra, pa.int32()), pa.array(own, pa.binary())],
                                      names=["k1", "k2", "m", "extra", "s"])

    return docs.where(F.col("n") <= largest).mapInArrow(run, "k1 bigint, k2 bigint, m int, extra int, s binary")


def light_links(docs: DataFrame, largest: int, rule: Rule) -> DataFrame:
    rows = staged(_light_rows(docs, largest, rule).distinct(), "subsets")
    least = staged(rows.groupBy("k1", "k2").agg(F.min(F.struct("extra", "s")).alias("e"), F.count("*").alias("c"))
                   .where("c > 1").select("k1", "k2", "e"), "subset-leaders")
    return (rows.join(least, ["k1", "k2"])
            .where(f"s <> e.s AND {rule.percent} * (extra + e.extra) <= {100 - rule.percent} * m").select(F.col("s").alias("a"), F.col("e.s").alias("b")))


class Leaders:
    """Compares the sets of one group with the group's leaders. A set that
    links with none becomes a leader itself, up to ``LEADERS``."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self.sets: list[tuple[bytes, np.ndarray]] = []

    def add(self, key: bytes, values: np.ndarray) -> tuple[list[bytes], bool]:
        """Up to ``ENOUGH`` leaders that link with the set; whether it now leads."""
        found = []
        for k, other in self.sets:
            if linked(values, other, self.rule):
                found.append(k)
                if len(found) == ENOUGH:
                    break
        lead = not found and len(self.sets) < LEADERS
        if lead:
            self.sets.append((key, values))
        return found, lead


def leader_links(docs: DataFrame, classes: DataFrame, larger_than: int, bits: int, rule: Rule) -> DataFrame:
    """Links of sets with leaders of their min-hash groups (some links, not
    all: they only unite near copies early)."""
    schema = "group bigint, s binary, data binary, other binary"

    def keys(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([batch.column(c).to_numpy() for c in ("h0", "h1")]).view(U)

    # Of distinct sets: copies alone make no group.
    shared = docs.sparkSession.sparkContext.broadcast(
        build_repeat_sketch(classes.where(F.col("n") > larger_than).select("h0", "h1"), keys, bits))

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 4
        return pa.record_batch([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                               names=["group", "s", "data", "other"])

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = RepeatSketch(bits, shared.value)
        for part in slabs(batches, "text"):
            groups: dict[int, Leaders] = {}
            out = []
            hashes = [part.column(c).to_numpy().view(U) for c in ("h0", "h1")]
            again = [repeated.repeated(h) for h in hashes]
            many = distinct_sets(part, rule.width, again[0] | again[1])
            for h01, yes01 in zip(hashes, again):
                found_at = dict(zip(part.column("s").to_pylist(), zip(h01.view(np.int64).tolist(), yes01.tolist())))
                for key, values in many.items():
                    h, yes = found_at[key]
                    if yes:
                        found, lead = groups.setdefault(h, Leaders(rule)).add(key, values)
                        out += [(h, key, None, other) for other in found]
                        if lead:
                            out.append((h, key, values.tobytes(), None))
            yield rows_of(out)

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leaders, last = None, Leaders(rule), None
        for batch in batches:
            out = []
            for h, key, data, other in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if data is None:
                    out.append((key, other))
                    continue
                if h != group:
                    group, leaders, last = h, Leaders(rule), None
                if key != last:                          # copies of one set follow one another
                    out += [(key, x) for x in leaders.add(key, np.frombuffer(data, U))[0]]
                    last = key
            cols = list(zip(*out)) or [(), ()]
            yield pa.record_batch([pa.array(c, pa.binary()) for c in cols], names=["a", "b"])

    return (docs.where(F.col("n") > larger_than).mapInArrow(first_round, schema).repartition("group").sortWithinPartitions("group", "s")
            .mapInArrow(second_round, "a binary, b binary"))


def _postings(docs: DataFrame, smallest: int, counts, bits: int, rule: Rule) -> DataFrame:
    """(token, s, n): sets of at least ``smallest`` in the lists of their
    rarest shingles, where another set of fitting size stands too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for part in slabs(batches, "text"):
            token, own, size = [], [], []
            for key, values in distinct_sets(part, rule.width).items():
                n = len(values)
                count = table[(values >> U(64 - bits)).astype(np.int64)]
                take = rule.depth(n) + 1
                chosen = values[np.lexsort((values, count))[:take]]
                token.append(chosen.view(np.int64))
                own += [key] * take
                size.append(np.full(take, n, np.int32))
            if own:
                yield pa.record_batch([pa.array(np.concatenate(token)), pa.array(own, pa.binary()),
                                       pa.array(np.concatenate(size))], names=["token", "s", "n"])

    def shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by list and size: the nearest other sizes are next to a row."""
        held, wanted = None, False          # the last row so far, and whether it stays
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token, own = batch.column("token").to_numpy(), batch.column("s").to_pylist()
            new = np.ones(len(own), bool)   # copies of a set follow one another
            new[1:] = (token[1:] != token[:-1]) | np.array([x != y for x, y in zip(own[1:], own)], bool)
            batch = batch.filter(pa.array(new))
            token, n = token[new], batch.column("n").to_numpy().astype(np.int64)
            near = (token[1:] == token[:-1]) & rule.fits(n[:-1], n[1:])
            stays = np.zeros(len(token), bool)
            stays[0] = wanted
            stays[:-1] |= near
            stays[1:] |= near
            held, wanted = batch.slice(len(token) - 1, 1), bool(stays[-1])
            yield batch.slice(0, len(token) - 1).filter(pa.array(stays[:-1]))
        if wanted:
            yield held

    schema = "token bigint, s binary, n int"
    return (docs.where(F.col("n") >= smallest).mapInArrow(run, schema).repartition("token").sortWithinPartitions("token", "n", "s")
            .mapInArrow(shared_lists, schema))


class _List:
    """One inverted list, read in order of size: (set, component, size,
    sketch). Rows that are too small for what follows are forgotten."""

    def __init__(self, token: int, rule: Rule = RULE, most: int | None = None):
        self.token, self.rule, self.most, self.held, self.fresh = token, rule, most, [], []
        self.cut = False         # whether ``most`` kept a pair back

    def add(self, row: tuple, out: set) -> None:
        self.fresh.append(row)
        if len(self.fresh) == LIST_BLOCK:
            self.meet(out)

    def meet(self, out: set) -> None:
        """Pairs of the fresh rows with one another and with those held."""
        fresh, self.fresh = self.fresh, []
        if not fresh:
            return
        self.held = [r for r in self.held if self.rule.fits(r[2], fresh[0][2])]
        if len({r[1] for r in (*self.held, *fresh)}) > 1:
            self.cut |= self._block(fresh, fresh, True, out, self.rule, self.most)
            for lo in range(0, len(self.held), LIST_BLOCK):
                self.cut |= self._block(fresh, self.held[lo:lo + LIST_BLOCK], False, out, self.rule, self.most)
        self.held += fresh

    @staticmethod
    def _block(a: list, b: list, same: bool, out: set, rule: Rule, most: int | None = None) -> bool:
        """Pairs of a row of ``a`` and one of ``b`` (an earlier one, if both
        are the ``same``) that may be linked; with ``most``, each row of ``a``
        proposes its nearest so many only. Tells whether a pair was kept back."""
        cut = False
        if len(a) * len(b) <= 256:
            for i, x in enumerate(a):
                mine = [y for y in (b[:i] if same else b)
                        if x[1] != y[1] and rule.fits(min(x[2], y[2]), max(x[2], y[2])) and may_link(x[3], y[3], x[2] + y[2], rule)]
                if most is not None and len(mine) > most:
                    cut = True
                    mine = sorted(mine, key=lambda y: differing(x[3], y[3]))[:most]
                out.update((min(x[0], y[0]), max(x[0], y[0])) for y in mine)
            return cut
        n, m = (np.array([r[2] for r in rows], np.int64) for rows in (a, b))
        roots, others = (np.array([r[1] for r in rows], np.int64) for rows in (a, b))
        x, y = (np.unpackbits(np.array([folded(r[3]) for r in rows]), axis=1).astype(np.float32) for rows in (a, b))
        apart = x.sum(axis=1)[:, None] + y.sum(axis=1)[None] - 2 * (x @ y.T)
        n, m = n[:, None], m[None]
        ok = (roots[:, None] != others[None]) & rule.fits(np.minimum(n, m), np.maximum(n, m)) & rule.may_differ(apart, n + m)
        if same:
            ok &= np.tri(len(a), k=-1, dtype=bool)
        if most is not None and len(b) > most:
            cut = bool((ok.sum(axis=1) > most).any())
            near = np.argpartition(np.where(ok, apart, np.inf), most - 1, axis=1)[:, :most]
            few = np.zeros_like(ok)
            np.put_along_axis(few, near, True, axis=1)
            ok &= few
        found = ((a[i], b[j]) for i, j in zip(*np.nonzero(ok)))
        out.update((min(x[0], y[0]), max(x[0], y[0])) for x, y in found if may_link(x[3], y[3], x[2] + y[2], rule))
        return cut


def _dealt(kept: DataFrame, rule: Rule) -> DataFrame:
    """(token, g, h, second, s, n, root): the rows of long lists, once for
    every pair of blocks (g, h) that they take part in; ``second`` tells the
    side. Sizes that fit lie in one class or in neighbouring ones."""
    ratio = np.log(100 / rule.percent) * 1.000001       # a little wide: rounding never parts sizes that fit
    rows = kept.withColumn("class", F.floor(F.log("n") / F.lit(float(ratio))))
    counts = staged(rows.groupBy("token", "class").agg(F.count("*").alias("c")), "list-sizes")
    long = counts.join(counts.groupBy("token").agg(F.sum("c").alias("all")).where(F.col("all") > LIST_ROWS), "token")
    blocks = long.select("token", "class", F.ceil(F.col("c") / LIST_ROWS).cast("int").alias("blocks"))
    around = staged(blocks.join(blocks.select("token", (F.col("class") - 1).alias("class"), F.col("blocks").alias("above")),
                                ["token", "class"], "left")
                    .join(blocks.select("token", (F.col("class") + 1).alias("class"), F.col("blocks").alias("below")),
                          ["token", "class"], "left").fillna(0, ["above", "below"]), "list-blocks")
    numbers = lambda lo, hi: F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    name = lambda up, i: F.concat_ws("-", F.col("class") + up, i)
    meets = lambda g, h, second: F.struct(g.alias("g"), h.alias("h"), F.lit(second).alias("second"))
    first, zero = F.col("blocks") - 1, F.lit(0)
    here = name(0, F.col("own"))
    groups = F.concat(
        F.transform(numbers(F.col("own"), first), lambda i: meets(here, name(0, i), False)),
        F.transform(numbers(zero, F.col("own") - 1), lambda i: meets(name(0, i), here, True)),
        F.transform(numbers(zero, F.col("above") - 1), lambda i: meets(here, name(1, i), False)),
        F.transform(numbers(zero, F.col("below") - 1), lambda i: meets(name(-1, i), here, True)))
    return (rows.join(around, ["token", "class"])
            .withColumn("own", F.pmod(F.xxhash64("s"), F.col("blocks")).cast("int"))
            .select("token", "s", "n", "root", F.explode(groups).alias("to"))
            .select("token", "to.g", "to.h", "to.second", "s", "n", "root"))


def _lists(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, s, n, root, c): the lists that hold sets of several components, and their rows."""
    rooted = staged(postings.join(labels.select(F.col("node").alias("s"), "root"), "s", "left")
                    .select("token", "s", "n", F.xxhash64(F.coalesce("root", "s")).alias("root")), "postings")
    # Lists within one component have no pair to offer.
    mixed = rooted.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("c")) \
        .where("x <> y").select("token", "c")
    return staged(rooted.join(mixed, "token").select("token", "s", "n", "root", "c"), "lists")


def _told(pairs: list, cut: list) -> pa.RecordBatch:
    """Pairs, and the lists that kept some back."""
    a, b = list(zip(*pairs)) or [(), ()]
    return pa.record_batch([pa.array([*a, *[None] * len(cut)], pa.binary()), pa.array([*b, *[None] * len(cut)], pa.binary()),
                            pa.array([*[None] * len(pairs), *cut], pa.int64())], names=["a", "b", "cut"])


def _candidates(kept: DataFrame, classes: DataFrame, rule: Rule, most: int | None = None) -> DataFrame:
    """(a, b, cut): sets of different components that share a list and may be
    linked by size and sketch, each pair once. ``most`` bounds what a row of a
    list proposes: its nearest partners; ``cut`` names the lists in which it did."""
    told_of = "a binary, b binary, cut bigint"
    long = kept.where(F.col("c") > LIST_ROWS).drop("c")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, told = _List(0, rule, most), set()          # pairs of earlier batches, as many as memory allows
        out: set[tuple[bytes, bytes]] = set()
        cut: list[int] = []

        def rows() -> pa.RecordBatch:
            fresh = sorted(out - told)
            if len(told) > 1 << 16:
                told.clear()
            told.update(fresh)
            out.clear()
            batch = _told(fresh, cut)
            cut.clear()
            return batch

        def finish() -> None:
            now.meet(out)
            if now.cut:
                cut.append(now.token)

        for batch in batches:
            for token, *row in zip(*(batch.column(c).to_pylist() for c in ("token", "s", "root", "n", "sketch"))):
                if token != now.token:
                    finish()
                    now = _List(token, rule, most)
                now.add(tuple(row), out)
                if len(out) > FLUSH:
                    yield rows()
            yield rows()
        finish()
        yield rows()

    def scan_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Both blocks of a pair, or one with itself; groups come one after another."""
        now, sides = None, ([], [])

        def told(out: set, cut: list) -> pa.RecordBatch:
            batch = _told(sorted(out), cut)
            out.clear()
            return batch

        def pairs() -> Iterator[pa.RecordBatch]:
            out: set[tuple[bytes, bytes]] = set()
            first, second = sides
            cut = False
            alone = now[1] == now[2]
            for i in range(0, len(first), LIST_BLOCK):
                a = first[i:i + LIST_BLOCK]
                if alone:
                    cut |= _List._block(a, a, True, out, rule, most)
                for j in range(0, i if alone else len(second), LIST_BLOCK):
                    cut |= _List._block(a, (first if alone else second)[j:j + LIST_BLOCK], False, out, rule, most)
                    if len(out) > FLUSH:
                        yield told(out, [])
            yield told(out, [now[0]] if cut else [])

        for batch in batches:
            for token, g, h, second, *row in zip(*(batch.column(c).to_pylist() for c in (
                    "token", "g", "h", "second", "s", "root", "n", "sketch"))):
                if (token, g, h) != now:
                    if now is not None:
                        yield from pairs()
                    now, sides = (token, g, h), ([], [])
                sides[second].append(tuple(row))
        if now is not None:
            yield from pairs()

    sketches = classes.select("s", "sketch")
    found = (kept.where(F.col("c") <= LIST_ROWS).join(sketches, "s").repartition("token")
             .sortWithinPartitions("token", "n").mapInArrow(scan, told_of))
    if not long.isEmpty():
        found = found.union(_dealt(long, rule).join(sketches, "s")
                            .repartition("token", "g", "h").sortWithinPartitions("token", "g", "h")
                            .mapInArrow(scan_blocks, told_of))
    return found.distinct()


def _verified(docs: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose whole sets are linked. A bloom table of the keys asked for
    picks the texts whose sets travel."""
    asked = pairs.select(F.col("a").alias("s")).union(pairs.select(F.col("b").alias("s"))).distinct()
    bits = bits_for(2 * pairs.count(), 0.1)
    head = lambda keys: np.frombuffer(b"".join(k[:8] for k in keys), U)
    shared = docs.sparkSession.sparkContext.broadcast(
        build_repeat_sketch(asked, lambda batch: head(batch.column("s").to_pylist()), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = RepeatSketch(bits, shared.value)
        for part in slabs(batches, "text"):
            have = distinct_sets(part, rule.width, table.contains(head(part.column("s").to_pylist())))
            yield pa.record_batch([pa.array(have, pa.binary()), pa.array([v.tobytes() for v in have.values()], pa.binary())],
                                  names=["s", "data"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            keys = batch.column("s").to_pylist()
            if keys:
                take = [k != p for k, p in zip(keys, [last, *keys])]
                last = keys[-1]
                yield batch.filter(pa.array(take))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y")))
            ok = [linked(np.frombuffer(x, U), np.frombuffer(y, U), rule) for _, _, x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    sets = staged(docs.mapInArrow(run, "s binary, data binary").repartition("s").sortWithinPartitions("s")
                  .mapInArrow(once, "s binary, data binary"), "sets")
    return (pairs.join(sets.select(F.col("s").alias("a"), F.col("data").alias("x")), "a")
            .join(sets.select(F.col("s").alias("b"), F.col("data").alias("y")), "b")
            .mapInArrow(check, "a binary, b binary"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                       percent: int = 90) -> DataFrame:
    """(id, n_shingles, component_id) for every row."""
    rule = Rule(width, percent)
    kind = docs.schema[id_col].dataType.simpleString()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, "text"):
            sets = sets_of(part.column("text"), width)
            hashes = [[min_hash(s, k) if len(s) else 0 for s in sets] for k in (0, 1)]
            yield pa.record_batch([part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                                   pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                                   pa.array([parity(s, rule) if len(s) else None for s in sets], pa.binary()),
                                   *(pa.array(np.array(h, U).view(np.int64)) for h in hashes), part.column("text")],
                                  names=["id", "n_shingles", "s", "sketch", "h0", "h1", "text"])

    # The texts stay beside their keys: later passes look at the sets that they need, not at all of them.
    rows = staged_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
                        .mapInArrow(keyed, f"id {kind}, n_shingles bigint, s binary, sketch binary, h0 bigint, h1 bigint, "
                                           "text string"), "set-keys")
    texts = rows.where("s is not null").select("s", F.col("n_shingles").alias("n"), "h0", "h1", "text")
    classes = staged(rows.where("s is not null").groupBy("s")
                     .agg(F.min("id").alias("low"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch"),
                          F.max("h0").alias("h0"), F.max("h1").alias("h1")), "set-classes")
    sizes = {r["n"]: r["c"] for r in classes.where(f"n <= {MAX_LIGHT}").groupBy("n").agg(F.count("*").alias("c")).collect()}
    light = boundary(sizes, rule)
    size = text_bytes(texts, "text")
    bits = min(COUNT_BITS, max(16, int(max(1, size // 40)).bit_length()))

    def shingles(batch: pa.RecordBatch) -> np.ndarray:
        found = [v for p in slabs([batch], "text") for v in distinct_sets(p, width).values()]
        return np.concatenate(found) if found else np.zeros(0, U)

    counts = texts.sparkSession.sparkContext.broadcast(build_counts(texts.select("s", "text"), shingles, bits))
    early = components(light_links(texts, light, rule).union(
        leader_links(texts, classes, light, bits_for(2 * classes.count(), 0.1), rule)))
    smallest = -(-percent * (light + 1) // 100)
    # Near copies in thousands: at first every row of a list proposes its nearest partners, and what links is
    # united. Then lists that kept pairs back pair whatever is left of different components; the others have
    # proposed all, and pairs once refuted are not looked at again.
    lists = _lists(_postings(texts, smallest, counts, bits, rule), early)
    proposed = staged(_candidates(lists, classes, rule, NEAREST), "nearest")
    near, cut = proposed.where("cut is null").select("a", "b"), proposed.where("cut is not null").select("cut").distinct()
    labels = components(_verified(texts, near, rule).union(early.where("node <> root").select("node", "root")))
    if not cut.isEmpty():
        left = lists.drop("root", "c").join(cut, F.col("token") == F.col("cut"), "left_semi")
        rest = staged(_candidates(_lists(left, labels), classes, rule).select("a", "b").join(near, ["a", "b"], "left_anti"), "rest")
        if not rest.isEmpty():
            labels = components(_verified(texts, rest, rule).union(labels.where("node <> root").select("node", "root")))
    lowest = classes.join(labels.withColumnRenamed("node", "s"), "s", "left") \
        .select("s", "low", F.coalesce("root", "s").alias("root"))
    lowest = staged(lowest, "rooted")
    named = staged(lowest.groupBy("root").agg(F.min("low").alias("component_id"))
                   .join(lowest.select("root", "s"), "root").select("s", "component_id"), "components")
    return (rows.where("s is not null").join(named, "s").select("id", "n_shingles", "component_id")
            .union(rows.where("s is null").select("id", "n_shingles", F.col("id").alias("component_id")))
            .withColumnRenamed("id", id_col))
