"""Collocations, conversation repair and the graph index against brute force:
nulls, empty and long texts, ties, repeated rows, clashing extra columns and
empty tables."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from fleetpulse.llm import collocations, conversations, hnsw  # noqa: E402
from fleetpulse.session import workers_import  # noqa: E402
import __spark_entry__ as E  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module", autouse=True)
def _workers(spark):
    workers_import(spark, E.ROOT)


# ---------------------------------------------------------------- collocations

def _brute_phrases(rows, least, longest=5):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in counts.items():
        often = {p: n for p, n in c.items() if n >= least and " " in p}
        for p, a in often.items():
            if any(n >= a and len(q) > len(p) and f" {p} " in f" {q} " for q, n in often.items()):
                continue
            w = p.split(" ")
            cut = min((1000 * a * total[lang] // (c[" ".join(w[:k])] * c[" ".join(w[k:])]), k,
                       c[" ".join(w[:k])], c[" ".join(w[k:])]) for k in range(1, len(w)))
            out.add((lang, p, a, cut[2], cut[3], total[lang], cut[0]))
    return out


def _phrase_rows():
    rnd = random.Random(11)
    words = ["a", "ab", "b\x01", "b", "Ä", "ä", "the", "of", "日本", "x\x00y", "c'd", "q-r"]
    texts = [None, "", " \t\n", "...", "one", "THE of the OF", "a b\x01 c, a b c a b c"]
    for _ in range(400):
        texts.append("".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0c"])
                             for _ in range(rnd.randint(0, 30))))
    texts += ["new york city hall now. " * 40, "the of " * 3000, "ab " * 500, "same text again here"] + ["same text again here"] * 9
    return [((None, "en", "de", "und")[i % 4], t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("least", [3, 20])
def test_collocations_equal_brute_force(spark, least):
    rows = _phrase_rows()
    docs = spark.createDataFrame([(i, t, l, 1, "x", 2.0) for i, (l, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, phrase string, score double").repartition(7)
    found = collocations.mine(docs, least=least)
    got = [tuple(r) for r in found.collect()]
    want = _brute_phrases(rows, least)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 10
    ranked = [tuple(r) for r in collocations.ranked(found, 7).collect()]
    told = []
    for lang in {r[0] for r in want}:
        mine = sorted((r for r in want if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:7]
        told += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine)]
    assert sorted(ranked) == sorted(told)


def test_slabs_hold_whole_texts_and_every_word(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(collocations, "SLAB", 200)
    rows = _phrase_rows()
    batches = [pa.record_batch([pa.array([t for _, t in rows[i:i + 50]], pa.string()),
                                pa.array([l or "und" for l, _ in rows[i:i + 50]], pa.string())], names=["text", "lang"])
               for i in range(0, len(rows), 50)]
    got = Counter()
    slabs = 0
    for slab, _, known in collocations._slabs(iter(batches)):
        slabs += 1
        for i in range(len(slab.start)):
            j = slab.ends[i]
            got[known[slab.lang[i]], bytes(slab.raw[slab.start[i]:slab.end[j - 1]]).decode()] += 1
    want = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update((lang or "und", " ".join(w[i:])) for i in range(len(w)))
    assert got == want and slabs > 20


def test_runs_that_cross_range_boundaries_are_summed(spark):
    rows = [("en", f"hot pair w{i:04d}", 2) for i in range(3000)] + [("en", "hot pair", 5), ("en", "hot", 0), ("a", "x y", 1)]
    windows = spark.createDataFrame(rows, "lang string, phrase string, n long").repartition(16)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {tuple(r) for r in collocations.prefix_counts(windows, 10).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {("en", "hot pair", 6005)}


def test_scores_pass_64_bits(spark):
    big = 10 ** 13
    counts = spark.createDataFrame([("en", "x", big, 1), ("en", "y", big - 1, 1), ("en", "x y", big - 7, 2)],
                                   "lang string, phrase string, n long, words int")
    totals = spark.createDataFrame([("en", 37 * big + 11)], "lang string, total long")
    row = collocations.scored(counts, totals).first()
    assert row.score == 1000 * (big - 7) * (37 * big + 11) // (big * (big - 1))


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.ranked(collocations.mine(docs)).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    assert collocations.ranked(collocations.mine(one)).count() == 0


# ---------------------------------------------------------------- conversations

def _edit_paths(rows):
    """Least (cost, audit, repaired) by uniform-cost search over all edits;
    rows: (role, text, must_go, truncated)."""
    after = {0: "u", 1: "u", 2: "a", 3: "u"}
    place_of = {"s": 1, "u": 2, "a": 3}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, place, out = heapq.heappop(heap)
        if i == len(rows) and place in (0, 3):
            return cost, audit, list(out)
        if (i, place) in done:
            continue
        done.add((i, place))
        new = {"u": "user", "a": "assistant"}[after[place]]
        heapq.heappush(heap, (cost + 2, audit + "I", i, place_of[after[place]], out + ((new, ""),)))
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, place, out))
            if not must_go:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, place_of[after[place]], out + ((new, text),)))
                if role[:1] == after[place] or (place == 0 and role[:1] == "s"):
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, place_of[role[:1]], out + ((role, text),)))


def _brute_repair(table):
    by = defaultdict(list)
    for conv, turn, role, text in table:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in by.items():
        shown = lambda x: " " if x is None else str(x)
        kept = []
        for turn, role, text in rows:
            harm = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
            if harm == 0:
                continue
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            kept += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
        digest = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        kept.sort(key=lambda r: ((r[0] is not None, r[0] or 0), r[1].encode(), digest(r)))
        turns = {t for t, _, _ in kept if t is not None}
        faults, seen, rows = Counter(), set(), []
        for _, role, text in kept:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else \
                "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            rows.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        initials = [r[0][:1] for r in rows]
        cost, audit, lines = _edit_paths(rows)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"],
                     faults["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def _talks():
    rnd = random.Random(12)
    texts = ["Hello there.", "Yes!", "no end", "", " \n", None, "What? ", "ok.\x0b", "日本。", "Long " * 3000 + "."]
    rows = []
    for conv in range(250):
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, rnd.choice([turn, turn, turn, None, turn * 2]),
                         rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "us"]), rnd.choice(texts)))
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (None, 2, "assistant", "Yes.")]
    rows += [(1000, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(1500)]
    rows += [(2000, None, "user", "a."), (2001, 5, "system", "only.")]
    gone = next(c for c in range(3000, 4000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "dropped.")], gone


def test_conversation_repair_equals_brute_force(spark):
    rows, gone = _talks()
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows],
                                  "conv_id long, turn long, role string, text string, audit string, cost int, digest string") \
        .repartition(5)
    turns = conversations.damaged(table)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_report(turns).collect()}
    want = _brute_repair(rows)
    assert got == want and len(got) == 255
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    # The turns that the operator itself gives hash to the same.
    lines = defaultdict(list)
    for r in conversations.repaired(turns, conversations.plan(turns)).collect():
        lines[r.conv_id].append((r.position, f"{r.role}:{r.text}"))
    for conv, row in got.items():
        told = sorted(lines[conv])
        assert [p for p, _ in told] == list(range(len(told)))
        assert hashlib.sha256("\n".join(x for _, x in told).encode()).hexdigest() == row[-1]


def test_search_for_edits_is_exact():
    rnd = random.Random(4)
    for n in range(9):
        for _ in range(150):
            codes = bytes(rnd.randrange(12) for _ in range(n))
            rows = [("sua?"[c & 3], "t", c >> 2 == 1, int(c >> 2 == 2)) for c in codes]
            assert conversations.cheapest(codes) == _edit_paths(rows)[:2]
    assert conversations.cheapest(bytes([1, 2]) * 50_000) == (0, "K" * 100_000)


def test_conversations_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair_report(conversations.damaged(none)).count() == 0


# ---------------------------------------------------------------- nearest neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id string, row int, node string, score string"


def _vectors():
    rng = np.random.default_rng(13)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + 0.6 * rng.normal(size=24)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[100][1]) for i in range(120)]                  # one vector, many rows
    rows += [(3000 + i, rng.normal(size=5).tolist()) for i in range(3)]     # another length
    rows += [(150, rows[7][1]), (150, rows[8][1]), (150, rows[7][1])]       # an id that repeats
    rows += [(4000, None), (4050, [0.0] * 24), (4100, [None] + [1.0] * 23), (4150, [float("nan")] + [1.0] * 23),
             (4200, [float("inf")] + [1.0] * 23), (None, rows[3][1]), (4250, [])]
    return rows


def _exact(rows, k):
    good = [(i, np.asarray(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for at, (i, q) in enumerate(good):
        if i % 50 == 0:
            s = [(-round(float(q @ v / np.sqrt((q @ q) * (v @ v))), 12), j) for n, (j, v) in enumerate(good)
                 if n != at and len(v) == len(q)]
            out.setdefault(i, []).append([(j, -d) for d, j in sorted(s)[:k]])
    return out


@pytest.mark.parametrize("shard", [8192, 300])
def test_graph_search_recall(spark, shard):
    rows = _vectors()
    table = spark.createDataFrame([(i, v, 1, "x", 2, "y", "z") for i, v in rows], SCHEMA).repartition(4)
    got = defaultdict(list)
    for r in sorted(hnsw.nearest(table, F.col("id") % 50 == 0, shard=shard).collect()):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = _exact(rows, 5)
    assert set(got) == set(want) and 3000 in got
    hit = total = 0
    for q, lists in want.items():
        assert sorted(x[0] for x in got[q]) == sorted(n + 1 for w in lists for n in range(len(w)))
        found = Counter((v, round(s, 9)) for _, v, s in got[q])
        truth = Counter((v, round(s, 9)) for w in lists for v, s in w)
        hit, total = hit + sum((found & truth).values()), total + sum(truth.values())
    assert hit / total >= 0.97
    # The vector that many rows share: its smallest ids in order, whichever shard they lie in.
    assert [v for _, v, _ in sorted(got[2000])] == [100, 2001, 2002, 2003, 2004]


def test_graph_search_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hnsw.nearest(none, F.col("id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert hnsw.nearest(one, F.col("id") % 50 == 0).count() == 0


def test_same_graph_from_a_task_that_runs_again():
    rng = np.random.default_rng(5)
    unit = hnsw._unit(rng.normal(size=(400, 8)))
    keys = np.arange(400, dtype=np.uint64)
    a, b = hnsw.build(unit, keys), hnsw.build(unit, keys)
    assert (a.ground == b.ground).all() and a.entry == b.entry and len(a.layers) == len(b.layers)
    assert ((a.ground >= -1) & (a.ground < 400)).all()


# ---------------------------------------------------------------- near copies in groups

@pytest.mark.parametrize("width, percent", [(5, 80), (3, 90)])
def test_a_group_of_near_copies_makes_few_pairs(spark, monkeypatch, width, percent):
    """Copies of one text with 1 to 4 words changed: fewer than two pairs a row
    are looked at, and the components are those of brute force."""
    from fleetpulse.llm import jaccard
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdeilnorst") for _ in range(6)) for _ in range(3000)]
    base = words[:100]
    texts = {}
    for i in range(1000):
        near = list(base)
        for at in rnd.sample(range(100), rnd.randint(1, 4)):
            near[at] = rnd.choice(words)
        texts[i] = " ".join(near)
    asked, whole = [], jaccard._verified

    def counted(docs, pairs, rule):
        asked.append(pairs.count())
        return whole(docs, pairs, rule)

    monkeypatch.setattr(jaccard, "_verified", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, width=width, percent=percent).collect()}
    assert sum(asked) < 2 * len(texts)

    sets = {i: {tuple(t.split()[k:k + width]) for k in range(101 - width)} for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in sets}
