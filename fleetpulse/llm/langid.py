"""Language ID: multinomial logistic regression on TF-IDF character n-grams.

Letters in lower case (everything else is a blank) give n-grams of 1 to 3
characters, hashed to ``DIMS`` features; weights are log(1 + count) times the
inverse document frequency, counted over all training documents, scaled to
length one. Follow-the-regularised-leader (per-coordinate rates, elastic net)
trains sparse weights on at most ``PER_LANG`` documents of each language and
``IN_ALL`` of all (documented bounds, chosen by a hash of the id; counts of one
n-gram in one of them over 65,535 count as that). A fifth of those is kept from
training to calibrate the temperature of the softmax. A text of no learned
language has weight on few trained n-grams and scores near chance, one over the
number of languages; ``Model.floor`` is the confidence under which a
language is anyone's guess. Where the kept-back rows do not reach it themselves
(languages that cannot be told apart), it is chance, which no score is under.

Defined cases: null texts and texts without a letter are ``und`` with score
0, and so is every text if there is nothing to learn from; with one language
only, it gets score 1; ties go to the language that sorts first; repeated
rows are predicted row by row; empty tables give empty results; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetpulse.llm.quality import held_out
from fleetpulse.llm.tables import with_fields
from fleetpulse.llm.textcore import slabs

DIMS_BITS = 14
DIMS = 1 << DIMS_BITS
PER_LANG, IN_ALL = 1200, 20000
ABOVE, REACH = 0.1, 0.99    # the floor's part of the way from chance to certainty; share of kept-back rows over it
ALPHA, BETA, L1, L2, EPOCHS, BATCH = 0.5, 1.0, 1e-4, 1e-4, 5, 32
GRID = np.exp(np.linspace(np.log(0.002), np.log(200), 160))      # temperatures that are tried
UNKNOWN = "und"
W = np.uint32
# Odd multipliers of the n-gram hash.
ODD = (W(0x9E3779B1), W(0x85EBCA77), W(0xC2B2AE3D))


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(features, counts) of a text; None without a letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[code]
    if not letter.any():
        return None
    code = np.where(letter, code, W(32))
    stays = np.ones(len(code), bool)
    stays[1:] = letter[1:] | letter[:-1]
    code = np.concatenate([[W(32)], code[stays], [W(32)]]).astype(W)
    one = code[code != 32] * ODD[0]
    two = (code[:-1] * ODD[1]) ^ (code[1:] * ODD[2] + W(1))
    three = (code[:-2] * ODD[0] + W(7)) ^ (code[1:-1] * ODD[1]) ^ (code[2:] * ODD[2] + W(3)) * ODD[0]
    h = np.concatenate([one, two, three])
    h = (h ^ (h >> W(15))) * ODD[1]
    count = np.bincount((h >> W(32 - DIMS_BITS)).astype(np.int64), minlength=DIMS) if len(h) > DIMS // 4 else None
    if count is None:
        return np.unique((h >> W(32 - DIMS_BITS)).astype(np.int64), return_counts=True)
    at = np.flatnonzero(count)
    return at, count[at]


class Model:
    def __init__(self, langs: list[str], idf: np.ndarray):
        self.langs, self.idf = langs, idf
        self.weights = np.zeros((DIMS, len(langs)), np.float32)
        self.bias = np.zeros(len(langs))
        self.temperature = 1.0
        self.reached = 0.0          # confidence that a share of REACH of the kept-back rows has

    def vector(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        v = np.log1p(count) * self.idf[at]
        return v / max(np.sqrt((v * v).sum()), 1e-12)

    def logits(self, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.vector(at, count) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = grams(text) if self.langs else None
        if found is None:
            return UNKNOWN, 0.0
        z = self.logits(*found) / self.temperature
        p = np.exp(z - z.max())
        k = int(np.argmax(p))
        return self.langs[k], float(p[k] / p.sum())

    def floor(self) -> float:
        chance = 1 / max(1, len(self.langs))
        floor = chance + ABOVE * (1 - chance)
        return floor if self.reached >= floor else chance

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> None:
        """FTRL-proximal over mini-batches, then temperature calibration."""
        n, c = len(rows), len(self.langs)
        order = np.random.default_rng(7).permutation(n)
        check, learn = (order[:n // 5], order[n // 5:]) if n >= 20 else (order, order)
        z = np.zeros((DIMS + 1, c))
        s = np.zeros((DIMS + 1, c))
        w = np.zeros((DIMS + 1, c))
        for _ in range(EPOCHS):
            for i in range(0, len(learn), BATCH):
                batch = learn[i:i + BATCH]
                x = np.zeros((len(batch), DIMS + 1), np.float32)
                x[:, DIMS] = 1
                for k, r in enumerate(batch):
                    x[k, rows[r][0]] = self.vector(*rows[r])
                used = np.flatnonzero(x.any(0))
                xu = x[:, used]
                p = xu @ w[used]
                p = np.exp(p - p.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(batch)), y[batch]] -= 1
                g = xu.T @ p
                s2 = s[used] + g * g
                z[used] += g - (np.sqrt(s2) - np.sqrt(s[used])) / ALPHA * w[used]
                s[used] = s2
                zu = z[used]
                w[used] = np.where(np.abs(zu) <= L1, 0, -(zu - np.sign(zu) * L1) / ((BETA + np.sqrt(s2)) / ALPHA + L2))
        self.weights, self.bias = w[:DIMS].astype(np.float32), w[DIMS]
        raw = np.array([self.logits(*rows[r]) for r in check]).reshape(len(check), c)
        self.temperature = temperature(raw, y[check])
        q = np.exp((raw - raw.max(1, keepdims=True)) / self.temperature)
        self.reached = float(np.quantile(1 / q.sum(1), 1 - REACH, method="lower")) if len(check) else 0.0


def temperature(raw: np.ndarray, y: np.ndarray) -> float:
    """The softmax temperature of least loss on kept-back rows. Each label counts
    as if one more row of every language had been seen (n rows right of n + c),
    so that separable rows, too, have a best temperature inside the grid."""
    n, c = raw.shape
    if not n or c < 2:
        return 1.0
    target = np.full((n, c), 1 / (n + c))
    target[np.arange(n), y] += n / (n + c)
    best, chosen = np.inf, 1.0
    for t in GRID:
        q = raw / t
        loss = (np.log(np.exp(q - q.max(1, keepdims=True)).sum(1)) + q.max(1) - (target * q).sum(1)).mean()
        if loss < best - 1e-9:
            best, chosen = loss, float(t)
    return chosen


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = PER_LANG, in_all: int = IN_ALL) -> Model:
    """Learn from rows whose crc32(id) mod 3 is not 1 and whose lang is known."""
    taught = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                         F.col(lang_col).cast("string").alias("lang")) \
        .where("lang is not null and text is not null").where(~held_out("id", 3, 1))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS + 1, np.int64), 0
        for part in slabs(batches, "text"):
            for text in part.column("text").to_pylist():
                found = grams(text)
                if found is not None:
                    df[found[0]] += 1
                    df[DIMS] += 1
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(at), pa.array(df[at])], names=["feature", "df"])

    df = np.zeros(DIMS + 1)
    for r in taught.select("text").mapInArrow(frequencies, "feature bigint, df bigint") \
            .groupBy("feature").agg(F.sum("df").alias("df")).collect():          # at most DIMS + 1 rows
        df[r["feature"]] = r["df"]
    counts = {r["lang"]: r["n"] for r in taught.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    model = Model(sorted(counts), np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1)
    if not counts:
        return model
    per_lang = max(1, min(per_lang, in_all // len(counts)))
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 1.5 * per_lang / n))])
    unit = (F.pmod(F.xxhash64(F.lit("language"), "id"), F.lit(1 << 30)) / float(1 << 30))
    chosen = taught.withColumn("order", unit).where(F.col("order") < share[F.col("lang")])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, "text"):
            found = [grams(t) for t in part.column("text").to_pylist()]
            ok = [f is not None for f in found]
            found = [f for f in found if f is not None]
            yield pa.record_batch([
                part.column("lang").filter(pa.array(ok)), part.column("order").filter(pa.array(ok)),
                pa.array([a.astype("<u2").tobytes() for a, _ in found], pa.binary()),
                pa.array([np.minimum(n, 65535).astype("<u2").tobytes() for _, n in found], pa.binary())],
                names=["lang", "order", "at", "n"])

    rows = chosen.select("lang", "order", "text") \
        .mapInArrow(features, "lang string, order double, at binary, n binary").orderBy("order", "lang", "at") \
        .limit(2 * per_lang * len(counts)).collect()
    seen: dict[str, int] = {}
    kept = []
    for r in rows:
        seen[r["lang"]] = seen.get(r["lang"], 0) + 1
        if seen[r["lang"]] <= per_lang:
            kept.append(r)
    if kept:
        y = np.array([model.langs.index(r["lang"]) for r in kept])
        model.train([(np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["n"], "<u2")) for r in kept], y)
    return model


def predicted(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score): ``keep`` columns as a struct."""
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, "text"):
            found = [shared.value.predict(t) for t in part.column("text").to_pylist()]
            yield pa.record_batch([part.column("row"), pa.array([f[0] for f in found], pa.string()),
                                   pa.array([f[1] for f in found], pa.float64())], names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, with_fields(rows, "row", "lang_pred string, score double"))
