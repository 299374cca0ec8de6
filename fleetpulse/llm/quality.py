"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts (shares of character kinds, word lengths, repeated
words and pairs, lines) are computed in tasks, vectorised over a slab's byte
buffer. The trees are fitted on at most ``TRAIN_ROWS`` labelled rows (chosen
by a hash of the id, a documented bound); features are cut into at most
``BINS`` quantile bins, and a level of a tree is grown from one histogram of
gradients and one of curvatures over (node, feature, bin). The fitted forest
is flattened into arrays (feature, threshold, left, right, value) that numpy
traverses for all rows of a batch at once.

Defined cases: null and empty texts have statistics 0 and a score like any
other; labels with null quality or id teach nothing, of several labels for
one id the largest counts; without usable labels the score is 0.5, with one
class only it is that class's share; repeated rows are scored row by row;
empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.tables import with_fields
from fleetpulse.llm.textcore import BASES, Words, slabs, windows

TRAIN_ROWS = 20_000
BINS, TREES, DEPTH, RATE, RIDGE, LEAST = 64, 80, 4, 0.1, 1.0, 3.0
THRESHOLD = 0.3

# Kinds of bytes: a fixed table over ASCII; the rest of UTF-8 counts as letters.
KINDS = ("upper", "lower", "digit", "space", "newline", "stop", "mark", "shout", "pipe", "symbol", "control", "wide")
_KIND = np.full(256, KINDS.index("wide"), np.int64)
_KIND[:128] = KINDS.index("symbol")
_KIND[:32] = KINDS.index("control")
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 0, 1, 2
for _text, _kind in ((" \t", "space"), ("\n\r", "newline"), (".,", "stop"), ("'\"();:-/", "mark"), ("!?", "shout"),
                     ("|", "pipe")):
    _KIND[[ord(c) for c in _text]] = KINDS.index(_kind)

FEATURES = [*(f"share_{k}" for k in KINDS), "log_bytes", "log_words", "word_bytes", "longest_word", "distinct_words",
            "top_word", "same_as_last", "distinct_pairs", "upper_of_letters", "line_words", "word_ends_symbol"]


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of hashes by text: the number of different ones, the largest count."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, o[at], np.diff(np.append(at, len(v))))
    return np.bincount(o[at], minlength=n).astype(float), top


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    words = Words(texts)
    n, k = len(texts), len(KINDS)
    import pyarrow.compute as pc
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(n), size)
    kinds = np.bincount(text * k + _KIND[words.raw], minlength=n * k).reshape(n, k).astype(float)
    lane, owner, many = words.lane(0), words.text_of(), np.maximum(words.count, 1)
    length = (words.end - words.start).astype(float)
    distinct, top = _per_text(lane, owner, n)
    pair = windows(lane, 2, BASES[1])
    within = owner[1:] == owner[:-1]
    pairs, _ = _per_text(pair[within], owner[:-1][within], n)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    same = np.bincount(owner[1:][within], (lane[1:] == lane[:-1])[within], minlength=n)
    last_kind = _KIND[words.raw[words.end - 1]] if len(length) else np.zeros(0, np.int64)
    ends = np.bincount(owner, np.isin(last_kind, (KINDS.index("symbol"), KINDS.index("shout"))), minlength=n)
    letters = np.maximum(kinds[:, 0] + kinds[:, 1], 1)
    return np.column_stack([
        kinds / np.maximum(size, 1)[:, None], np.log1p(size), np.log1p(words.count),
        np.bincount(owner, length, minlength=n) / many, longest, distinct / many, top / many, same / many,
        pairs / np.maximum(words.count - 1, 1), kinds[:, 0] / letters,
        words.count / (kinds[:, KINDS.index("newline")] + 1), ends / many])


class Forest:
    """Boosted trees for a 0/1 target, flattened into arrays."""

    def __init__(self, base: float):
        self.base = base
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []
        self.roots: list[int] = []

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> "Forest":
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        forest = cls(float(np.log(share / (1 - share))))
        if len(y) == 0 or y.min() == y.max():
            return forest.frozen()
        f = x.shape[1]
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(f)]
        binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
        margin = np.full(len(y), forest.base)
        column = np.arange(f) * BINS
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            forest.roots.append(len(forest.feature))
            where = np.full(len(y), forest._leaf(g.sum(), h.sum()))
            open_nodes = [int(where[0])]
            for _ in range(DEPTH):
                local = {node: i for i, node in enumerate(open_nodes)}
                slot = np.array([local.get(w, -1) for w in range(len(forest.feature))])[where]
                rows = np.flatnonzero(slot >= 0)
                if not len(rows):
                    break
                cell = (slot[rows, None] * (f * BINS) + column + binned[rows]).ravel()
                shape = (len(open_nodes), f, BINS)
                gh = [np.bincount(cell, np.repeat(v[rows], f), minlength=np.prod(shape)).reshape(shape).cumsum(2)
                      for v in (g, h)]
                total = [v[:, :1, -1:] for v in gh]
                gain = sum(a ** 2 / (b + RIDGE) for a, b in ((gh[0], gh[1]), (total[0] - gh[0], total[1] - gh[1]))) \
                    - total[0] ** 2 / (total[1] + RIDGE)
                gain[(gh[1] < LEAST) | (total[1] - gh[1] < LEAST)] = -1
                best = gain.reshape(len(open_nodes), -1).argmax(1)
                children = []
                for i, node in enumerate(open_nodes):
                    j, b = divmod(int(best[i]), BINS)
                    if gain[i, j, b] <= 1e-6 or b >= len(edges[j]):
                        continue
                    at = [gh[k][i, j, b] for k in (0, 1)]
                    lo = forest._leaf(*at)
                    hi = forest._leaf(total[0][i, 0, 0] - at[0], total[1][i, 0, 0] - at[1])
                    forest.feature[node], forest.threshold[node] = j, float(edges[j][b])
                    forest.left[node], forest.right[node] = lo, hi
                    mine = rows[slot[rows] == i]
                    where[mine] = np.where(binned[mine, j] <= b, lo, hi)
                    children += [lo, hi]
                open_nodes = children
                if not children:
                    break
            margin += np.array(forest.value)[where]
        return forest.frozen()

    def _leaf(self, g: float, h: float) -> int:
        node = len(self.feature)
        for column, v in ((self.feature, 0), (self.threshold, np.inf), (self.left, node), (self.right, node),
                          (self.value, -RATE * g / (h + RIDGE))):
            column.append(v)
        return node

    def frozen(self) -> "Forest":
        for name, kind in (("feature", np.int64), ("threshold", float), ("left", np.int64), ("right", np.int64),
                           ("value", float), ("roots", np.int64)):
            setattr(self, name, np.array(getattr(self, name), kind))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        row = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                low = x[row, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            margin += self.value[node]
        return 1 / (1 + np.exp(-margin))


def held_out(id_col: str, parts: int, part: int):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        train_rows: int = TRAIN_ROWS) -> Forest:
    """Learn from labelled rows whose crc32(id) mod 5 is not 0."""
    taught = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("quality"))
              .where("id is not null and quality is not null").where(~held_out("id", 5, 0))
              .groupBy("id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("id"), "id").limit(train_rows))             # the proven bound of the broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, "text"):
            x = statistics(part.column("text"))
            yield pa.record_batch([part.column("id"), part.column("quality"), pa.array(list(x), pa.list_(pa.float64()))],
                                  names=["id", "quality", "x"])

    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(taught), "id").select(F.col("id").cast("string").alias("id"), "text", "quality")
            .mapInArrow(run, "id string, quality double, x array<double>")
            .orderBy("id", "x").limit(train_rows).toPandas())
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return Forest.fit(x, rows["quality"].to_numpy(float))


def scored(docs: DataFrame, forest: Forest, keep: list[str], text_col: str = "text") -> DataFrame:
    """(row, score): ``keep`` columns as a struct, with each text's score."""
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, "text"):
            score = shared.value.predict(statistics(part.column("text")))
            yield pa.record_batch([part.column("row"), pa.array(score)], names=["row", "score"])

    return rows.mapInArrow(run, with_fields(rows, "row", "score double"))
