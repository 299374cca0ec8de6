"""Corpus operators against brute force on a small table that holds nulls,
empty and long texts, repeated rows, ties, near copies and clashing extra
columns; and on empty tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from fleetpulse.llm import (bpe, jaccard, langid, licenses, neighbours, packing, quality,  # noqa: E402
                            substring, topk, urls)
from fleetpulse.session import workers_import  # noqa: E402
import __spark_entry__ as E  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, s long"
WORD = r"[^\x20\x09-\x0D]+"


def _texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeilnorst") for _ in range(rnd.randint(1, 8))) for _ in range(400)]
    pick = lambda n: [rnd.choice(words) for _ in range(n)]
    base = pick(300)
    texts = [None, "", " \n ", "one", "Two words", "TWO words", "a b c", "A B C", "é ß İK 日本 words"]
    for k in range(12):                                   # near copies, some under the threshold
        near = list(base)
        for _ in range(rnd.randint(0, 5)):
            near[rnd.randrange(300)] = rnd.choice(words)
        texts.append(" ".join(near))
    for n in (10, 15, 19, 20, 24, 29, 31, 60):            # small and larger sets, with a word less or changed
        own = pick(n + 2)
        texts += [" ".join(own), " ".join(own[1:]), " ".join(own[:-1]), " ".join([*own[:-1], "other"]),
                  " ".join(["first", *own[1:]])]
    passage = pick(60)
    texts += [" ".join(pick(40) + passage + pick(30)), "\n".join(passage), " ".join(pick(5) + passage[:34])]
    texts += ["The " * 200, " ".join(pick(20000)), " ".join(base), " ".join(base)]
    texts += ["Licensed under CC BY-NC 4.0.", "x GNU General Public License, cc by, All rights reserved. cc-by",
              "This work is licensed under the GNU General Public License, version 3.", "released under the MIT license",
              "apache license", "it's  we'll\t 12.5\n\n x "]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    workers_import(spark, E.ROOT)
    rows = [(i, t, ("en", "de")[i % 2], "src0", len(t or ""), "r", "x", 7) for i, t in enumerate(_texts())]
    rows += [rows[12], rows[12], (None, "no id here", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_bpe_equals_the_library_and_decodes(docs, nothing):
    tiktoken = pytest.importorskip("tiktoken")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(open(path, "rb").read())
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    out = bpe.encode_decode(docs, path).collect()
    assert len(out) == docs.count()
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode()
    assert bpe.encode_decode(nothing, path).count() == 0


def test_merge_replay_on_random_strings():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.read_ranks(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("aabehilnorst éüñж日'\x1c  \n") for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    got = bpe.ChunkEncoder(bpe.MergeReplay(ranks)).texts(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode_ordinary(t) for t in texts]


def test_packing(docs, nothing):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    special = ["a b <|endoftext|> c", "<|endoftext|>", "x<|endoftext|>y  <|endoftext|>", "<|endoftext|><|endoftext|> <|endoftext",
               "a\n<|endoftext|>\n b", "a b <|endoftext |> c"]
    more = [(10 ** 6 + i, t) for i, t in enumerate(special)]
    assert library.encode(special[0], add_special_tokens=False).ids == [64, 275, 220, 50256, 269]
    docs = docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame(more, "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = packing.pack_documents(docs, path, group=16).collect()
    ids = {d: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for d, t in texts.items()}
    copies = Counter(r.doc_id for r in docs.collect())
    assert Counter({d: len(x) // 4 * copies[d] for d, x in ids.items()}) == Counter(
        {d: sum(r.length for r in rows if r.doc_id == d) for d in ids})
    windows = {}
    for r in rows:
        assert bytes(r.ids) == ids[r.doc_id][4 * r.start:4 * (r.start + r.length)]
        assert r.doc_tokens == len(ids[r.doc_id]) // 4 and len(r.ids) == 4 * r.length
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert packing.pack_documents(nothing, path).count() == 0


def test_a_tokenizer_with_blanks_in_its_special_strings_takes_texts_whole():
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.add_special_tokens([tokenizers.AddedToken("<end of text>", special=True), tokenizers.AddedToken("<s>", lstrip=True)])
    texts = ["a <end of text> b", "a   <s> c", "", "plain words", "<end of text>"]
    got = packing._worker(library.to_str()).texts(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


def test_differencing_spreads_evenly_and_keeps_the_capacity():
    rnd = random.Random(1)
    for _ in range(20):
        sizes = [rnd.randint(1, 256) for _ in range(rnd.randint(1, 300))]
        parts = packing.pack(sizes, 1024)
        assert sorted(i for p in parts for i in p) == list(range(len(sizes)))
        assert max(sum(sizes[i] for i in p) for p in parts) <= 1024
        assert len(parts) <= -(-sum(sizes) // 1024) + 2


def test_substring_dedup(docs, nothing):
    rows = docs.collect()
    words = [re.findall(WORD, r.text or "") for r in rows]
    count = Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    want = []
    for r, w in zip(rows, words):
        stays = [True] * len(w)
        for i in range(len(w) - 34):
            if count[tuple(w[i:i + 35])] > 1:
                stays[i:i + 35] = [False] * 35
        kept = [x for x, y in zip(w, stays) if y]
        want.append((r.doc_id, " ".join(kept), len(w), len(w) - len(kept)))
    got = [(r.row.doc_id, r.kept, r.n_words, r.n_removed) for r in substring.remove_repeats(docs, ["doc_id"]).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(x[3] for x in got) > 500
    assert substring.remove_repeats(nothing, ["doc_id"]).count() == 0


def test_jaccard_components(docs, nothing):
    sets, copies = {}, []
    for r in docs.collect():
        w = re.findall(WORD, _lower(r.text))
        copies.append(r.doc_id)
        sets[r.doc_id] = frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) > 2 \
            else frozenset([tuple(w)] if w else [])
    ids = sorted(d for d in sets if d is not None)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = jaccard.jaccard_components(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == \
        sorted(((d, len(sets[d]), None if d is None else find(d)) for d in copies), key=repr)
    assert len({find(d) for d in ids}) < len(ids) - 15
    assert jaccard.jaccard_components(nothing).count() == 0


def test_subset_rule_equals_the_condition():
    """9 * (i + j) <= m holds exactly where 100 * m >= 90 * (m + i + j)."""
    for m in range(0, 60):
        for i in range(8):
            for j in range(8):
                assert (9 * (i + j) <= m) == (100 * m >= 90 * (m + i + j))
    assert jaccard.boundary({5: 10, 15: 10}) >= 15
    assert jaccard.boundary({29: 100}) < 29


def test_lists_lose_no_linked_pair():
    """Sketches never part linked sets, narrow or wide, nor do blocks of a list
    that is read by size; every pair comes once."""
    rnd = np.random.default_rng(4)
    rows, sets = [], []
    for n in (20, 20, 300, 560, 590, 605, 640, 2500):
        base = rnd.integers(0, 2 ** 63, n).astype(np.uint64)
        for k in range(12):
            values = np.unique(np.concatenate([base[k * n // 200:], rnd.integers(0, 2 ** 63, k * n // 300).astype(np.uint64)]))
            sets.append(values)
            rows.append((jaccard.set_key(values), len(rows), len(values), jaccard.parity(values)))
    true = {tuple(sorted((rows[i][0], rows[j][0]))) for i in range(len(rows)) for j in range(i)
            if rows[i][0] != rows[j][0] and jaccard.linked(sets[i], sets[j])}
    assert len(true) > 100
    for size in (3, 16, 1024):
        jaccard.LIST_BLOCK, before = size, jaccard.LIST_BLOCK
        try:
            found, one = set(), jaccard._List(7)
            for row in sorted(rows, key=lambda r: r[2]):
                one.add(row, found)
            one.meet(found)
        finally:
            jaccard.LIST_BLOCK = before
        assert true <= found
        assert len(found) < 2 * len(true)


def test_long_lists_are_dealt_in_blocks(spark, monkeypatch):
    """No group of a long list grows with it, and every fitting pair meets once."""
    workers_import(spark, E.ROOT)
    monkeypatch.setattr(jaccard, "LIST_ROWS", 50)
    rnd = random.Random(6)
    sizes = [rnd.choice((36, 36, 36, 38, 40, 41, 45, 50, 60)) for _ in range(400)]
    kept = spark.createDataFrame([(7, bytes([i % 256, i // 256]), n, i) for i, n in enumerate(sizes)],
                                 "token long, s binary, n int, root long")
    groups = {}
    for r in jaccard._dealt(kept, jaccard.RULE).collect():
        groups.setdefault((r.g, r.h), ([], []))[r.second].append(r.root)
    assert max(len(a) + len(b) for a, b in groups.values()) < 4 * 50
    met = Counter()
    for (g, h), (a, b) in groups.items():
        met.update((min(x, y), max(x, y)) for i, x in enumerate(a) for y in (a[:i] if g == h else b))
    assert set(met.values()) == {1}
    assert {(i, j) for j in range(400) for i in range(j) if jaccard.RULE.fits(min(sizes[i], sizes[j]), max(sizes[i], sizes[j]))} <= set(met)


def test_templated_family_of_one_long_list(spark, monkeypatch):
    workers_import(spark, E.ROOT)
    monkeypatch.setattr(jaccard, "LIST_ROWS", 30)
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdeilnorst") for _ in range(7)) for _ in range(2000)]
    base = words[:38]
    texts = [[*base[:19], w, *base[20:]] for w in words[100:300]]      # one slot changed: 33 of 39, nobody links
    for t in list(texts[:40]):
        texts.append(t + [rnd.choice(words)])                         # a word more: 36 of 37, linked
    texts = {i: " ".join(t) for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert got == _brute_components(texts, 3, 90)
    assert len(set(got.values())) == 200


def test_quality_learns_and_is_defined_everywhere(spark, nothing):
    rnd = random.Random(2)
    good = lambda: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(40)) + "."
    bad = lambda: " | ".join("x$$$" for _ in range(40))
    rows = [(i, good() if i % 3 else bad(), "en", "s", 0, None, None, None) for i in range(400)]
    docs = spark.createDataFrame([*rows, (900, None, None, None, None, None, None, None), (901, "", None, None, 0, None, None, None)], SCHEMA)
    labels = spark.createDataFrame([(i, int(bool(i % 3)), 0) for i in range(400)] + [(3, None, 0), (None, 1, 0), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    out = quality.scored(docs, quality.fit(docs, labels), ["doc_id"]).collect()
    assert len(out) == 402 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.row.doc_id < 400 and zlib.crc32(str(r.row.doc_id).encode()) % 5 == 0]
    assert held and all((r.score >= 0.3) == bool(r.row.doc_id % 3) for r in held)
    empty = quality.fit(nothing, labels)
    assert {r.score for r in quality.scored(docs, empty, ["doc_id"]).collect()} == {0.5}
    assert quality.scored(nothing, empty, ["doc_id"]).count() == 0


def test_language(spark, docs, nothing):
    rnd = random.Random(4)
    letters = {"aa": "abcde", "bb": "vwxyz", "cc": "äöüßø"}
    text = lambda lang: " ".join("".join(rnd.choice(letters[lang]) for _ in range(4)) for _ in range(12))
    rows = [(i, text(lang), lang, "s", 0, None, None, None) for i in range(150) for lang in (sorted(letters)[i % 3],)]
    rows += [(500, None, "aa", "s", 0, None, None, None), (501, "12 !!", "aa", "s", 0, None, None, None),
             (502, "abcd", None, "s", 0, None, None, None)]
    table = spark.createDataFrame(rows, SCHEMA)
    out = {r.row.doc_id: r for r in langid.predicted(table, langid.fit(table), ["doc_id", "lang"]).collect()}
    assert (out[500].lang_pred, out[501].lang_pred, out[502].lang_pred) == ("und", "und", "aa")
    assert all(r.lang_pred == r.row.lang and r.score > 0.5 for d, r in out.items() if d < 150)
    none = langid.fit(nothing)
    assert {r.lang_pred for r in langid.predicted(table, none, ["doc_id"]).collect()} == {"und"}
    assert langid.predicted(nothing, none, ["doc_id"]).count() == 0


def test_texts_of_no_learned_language_score_under_the_floor(spark):
    rnd = random.Random(8)
    sounds = {"aa": "ba be bi do du ga".split(), "bb": "stra pfle scho wer ung".split(), "cc": "é ça où ña ço".split()}
    text = lambda lang, n=25: " ".join("".join(rnd.choices(sounds[lang], k=rnd.randint(1, 4))) for _ in range(n))
    rows = [(i, text(lang), lang) for i in range(300) for lang in (sorted(sounds)[i % 3],)]
    strange = ["人人生而自由在尊严和权利上一律平等", "Все люди рождаются свободными и равными", "kyzykmyx hyvvyn txyk jylly"]
    rows += [(900 + i, t, None) for i, t in enumerate(strange)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(table)
    assert 1 / 3 < model.floor() < 0.5 and langid.GRID[0] < model.temperature < langid.GRID[-1]
    for r in langid.predicted(table, model, ["doc_id"]).collect():
        assert (r.score >= model.floor()) == (r.row.doc_id < 900), r
    assert langid.Model(["aa"], model.idf).floor() == 1 == langid.Model(["aa"], model.idf).predict("x")[1]
    # Languages that cannot be told apart: nothing goes for its score.
    mixed = table.where("lang is not null").withColumn("lang", F.when(F.col("doc_id") % 7 < 3, "aa").otherwise("bb"))
    guess = langid.fit(mixed)
    assert guess.floor() == 0.5
    assert langid.predicted(table, guess, ["doc_id"]).where(F.col("score") < guess.floor()).count() == 0
    few = langid.fit(table, in_all=30)          # ten documents a language
    assert np.isfinite(few.weights).all() and few.langs == model.langs


def test_temperature_is_the_least_loss_and_never_at_an_edge():
    rnd = np.random.default_rng(3)
    y = rnd.integers(0, 4, 500)
    for scale in (0.05, 1.0, 30.0):
        raw = rnd.standard_normal((500, 4)) * 0.1 * scale
        raw[np.arange(500), y] += 3 * scale                   # separable rows
        t = langid.temperature(raw, y)
        assert langid.GRID[0] < t < langid.GRID[-1]
        assert abs(np.log(t / (langid.temperature(raw * 7, y) / 7))) < 0.2      # follows the scale
    mixed = rnd.standard_normal((20000, 4)) * 2               # labels drawn at a temperature of 0.8
    p = np.exp(mixed / 0.8)
    y = (p.cumsum(1) / p.sum(1, keepdims=True) < rnd.random((20000, 1))).sum(1)
    assert abs(langid.temperature(mixed, y) - 0.8) < 0.08
    assert langid.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_ftrl_follows_the_rule_coordinate_by_coordinate(monkeypatch):
    monkeypatch.setattr(langid, "EPOCHS", 3)
    texts = ["abc abd", "abd ab", "xyz xyy", "yz xx", "abc xyz"]
    rows, y = [langid.grams(t) for t in texts], np.array([0, 0, 1, 1, 1])
    model = langid.Model(["aa", "bb"], np.linspace(1, 2, langid.DIMS))
    model.train(rows, y)
    order = np.random.default_rng(7).permutation(5)           # one batch of all rows, three times
    cells = sorted({int(f) for at, _ in rows for f in at})
    x = {r: dict(zip(map(int, rows[r][0]), model.vector(*rows[r]))) | {-1: 1.0} for r in order}
    z, s, w = Counter(), Counter(), Counter()
    for _ in range(3):
        g = Counter()
        for r in order:
            e = [math.exp(sum(v * w[f, k] for f, v in x[r].items())) for k in (0, 1)]
            for f, v in x[r].items():
                for k in (0, 1):
                    g[f, k] += v * (e[k] / sum(e) - (y[r] == k))
        for c in g:
            rate = (math.sqrt(s[c] + g[c] ** 2) - math.sqrt(s[c])) / langid.ALPHA
            z[c] += g[c] - rate * w[c]
            s[c] += g[c] ** 2
            w[c] = 0 if abs(z[c]) <= langid.L1 else -(z[c] - math.copysign(langid.L1, z[c])) / (
                (langid.BETA + math.sqrt(s[c])) / langid.ALPHA + langid.L2)
    assert np.allclose(model.weights[cells], [[w[f, 0], w[f, 1]] for f in cells], atol=1e-5)
    assert np.allclose(model.bias, [w[-1, 0], w[-1, 1]], atol=1e-5)


VECTORS = "vec_id long, embedding array<float>, label int, v string, node int"


def _vectors():
    rnd = np.random.default_rng(6)
    base = rnd.standard_normal((40, 8))
    rows = [(i, [float(x) for x in base[i % 40] + (i // 40) * 0.02 * rnd.standard_normal(8)], i % 40 % 3, None, None)
            for i in range(160)]
    rows += [(200, rows[0][1], 0, None, None), (201, rows[0][1], 0, None, None), (202, None, 0, None, None),
             (203, [1.0, None] + [0.0] * 6, 0, None, None), (204, [float("nan")] * 8, 0, None, None),
             (205, [0.0] * 8, 0, None, None), (206, rows[0][1], None, None, None), (207, [1.0, 2.0], 0, None, None),
             (208, [float("inf")] + [0.0] * 7, 0, None, None)]
    return rows


def test_top_k(spark):
    rows = _vectors()
    # Rows that repeat an id: one with the same vector, one of a query with another.
    rows += [rows[5], (50, rows[7][1], *rows[50][2:])]
    table = spark.createDataFrame(rows, VECTORS)
    x = [(r[0], [math.floor(256 * float(np.float32(c))) for c in r[1]]) for r in rows
         if r[0] is not None and r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    want = []
    for n, (q, v) in enumerate(x):
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), c) for m, (c, w) in enumerate(x)
                           if m != n and len(w) == len(v))[:5]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(found, 1)]
    got = topk.top_k(table, F.col("id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(table.limit(0), F.col("id") % 50 == 0).count() == 0


def test_branch_and_bound_equals_a_full_scan():
    rnd = np.random.default_rng(9)
    q, c = rnd.integers(-200, 200, (20, 64)).astype(float), rnd.integers(-200, 200, (900, 64)).astype(float)
    c[100:200] = c[100]                                   # ties
    ids = np.arange(1000, 1900)
    got = topk.search(q, ids[:20], c, ids, 5)
    for i in range(20):
        s = c @ q[i]
        best = [j for j in np.lexsort((ids, -s)) if j != i][:5]
        assert [(j, v) for k, j, v in got if k == i] == [(j, s[j]) for j in best]


def test_neighbours(spark):
    rows = _vectors()
    got = {r.vec_id: r for r in neighbours.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert len(got) == len(rows)
    unit = {}
    for v, e, label, *_ in rows:
        if label is not None and e is not None and None not in e and np.isfinite(e).all() and any(e):
            m = np.array(e, np.float32).astype(float)
            unit[v] = (label, m / np.sqrt(m @ m))
    root, links = {r[0]: r[0] for r in rows}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (la, x) in unit.items():
        for b, (lb, y) in unit.items():
            if a != b and la == lb and len(x) == len(y) and x @ y >= 0.93:
                links[a] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert {v: (r.n_links, r.component_id, r.kept) for v, r in got.items()} == \
        {v: (links[v], find(v), find(v) == v) for v in root}
    assert neighbours.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def _pairs_table(spark, sizes, seed=11):
    """Labels of so many (vectors, pairs): vectors apart from one another, some with one near copy."""
    rnd = np.random.default_rng(seed)
    rows, links = [], {}
    for label, (n, pairs) in enumerate(sizes):
        x = rnd.standard_normal((n, 64))
        x[1:2 * pairs:2] = x[:2 * pairs:2] + 0.33 * rnd.standard_normal((pairs, 64))
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = np.flatnonzero((unit[:2 * pairs:2] * unit[1:2 * pairs:2]).sum(1) >= 0.93)
        links.update({len(rows) + 2 * int(i) + k: len(rows) + 2 * int(i) for i in near for k in (0, 1)})
        rows += [(len(rows) + i, v.tolist(), label) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4), links


def test_signature_bits_follow_each_labels_own_size(spark):
    """Small labels beside a hot one keep all their links."""
    workers_import(spark, E.ROOT)
    classes = spark.createDataFrame([("hot", 20000), ("small", 500), ("one", 1)], "label string, n long")
    assert {r.label: r.bits for r in neighbours.with_bits(classes).collect()} == {"hot": 9, "small": 3, "one": 0}
    table, links = _pairs_table(spark, [(6000, 0), (500, 250), (300, 100)])
    got = {r.vec_id: r.component_id for r in neighbours.near_duplicates(table).where("n_links > 0").collect()}
    assert len(links) > 400 and got == links


@pytest.mark.parametrize("rounds", [0, 1])
def test_recall_is_secured_where_links_are_rare(spark, monkeypatch, rounds):
    """One node in a hundred has a link: the audit plants its own, and what
    rounds do not find is compared whole."""
    workers_import(spark, E.ROOT)
    monkeypatch.setattr(neighbours, "ROUNDS", rounds)
    monkeypatch.setattr(neighbours, "RECALL", 1.0)
    table, links = _pairs_table(spark, [(3000, 30), (1200, 300)])
    got = {r.vec_id: r.component_id for r in neighbours.near_duplicates(table).where("n_links > 0").collect()}
    assert len(links) > 300 and got == links


def test_no_label_is_compared_whole_by_its_size_or_for_lack_of_links(spark, monkeypatch):
    """Small labels, sparse ones and one without a link all go through the graph."""
    workers_import(spark, E.ROOT)
    whole = []
    keep = neighbours.staged

    def watched(df, name):
        out = keep(df, name)
        if name == "compared":
            whole.append(out.count())
        return out
    monkeypatch.setattr(neighbours, "staged", watched)
    table, links = _pairs_table(spark, [(40, 10), (400, 100), (5000, 0), (2000, 40), (1, 0), (2, 1)])
    got = {r.vec_id: r.component_id for r in neighbours.near_duplicates(table).where("n_links > 0").collect()}
    assert whole == [0]
    assert got.items() <= links.items() and len(got) >= 0.98 * len(links) > 200


def test_planted_copies_stand_at_their_cosine():
    for dims in (1, 2, 64):
        x = np.random.default_rng(dims).standard_normal(dims)
        y = np.frombuffer(neighbours.perturbed("n", x.tobytes(), 0.937), "<f8")
        assert abs(x @ y / np.sqrt((x @ x) * (y @ y)) - (1.0 if dims == 1 else 0.937)) < 1e-12
        assert neighbours.perturbed("n", x.tobytes(), 0.937) == y.tobytes()


def test_block_forest_keeps_components():
    rnd = np.random.default_rng(3)
    for share in (0.0, 0.02, 0.2):
        hit = rnd.random((40, 50)) < share
        first, second = neighbours._forest(hit)
        low = []
        for links in ([(i, 40 + j) for i, j in zip(*np.nonzero(hit))], list(zip(first, second))):
            root = list(range(90))
            for _ in range(90):
                for x, y in links:
                    root[x] = root[y] = min(root[x], root[y])
            low.append(root)
        assert low[0] == low[1] and len(first) < 90


def test_url_filters_as_of(spark):
    entries = spark.createDataFrame(
        [("bad.example.com", 10, "add"), ("bad.example.com", 20, "remove"), ("bad.example.com", 30, "add"),
         ("bad.example.com", 10, "add"), ("example.org", 5, "add"), ("example.org", 5, "remove"),
         ("x.net/en", 7, "add"), (None, 1, "add"), ("x.net", None, "add"), ("y.net", 3, None)],
        "pattern string, day int, action string")
    captures = [(1, "http://bad.example.com/a", 9), (2, "http://BAD.example.com/a", 10), (3, "https://m.bad.example.com", 19),
                (4, "http://bad.example.com/", 20), (5, "http://bad.example.com:80?x", 31), (6, "http://example.org/", 9),
                (7, "http://x.net/en/1", 8), (8, "http://x.net/de", 8), (9, None, 8), (10, "", 8), (11, "no url", 8),
                (7, "http://x.net/en/1", 8)]
    table = spark.createDataFrame(captures, "id long, url string, day int")
    got = {r.id: (r.n_active, r.rule) for r in urls.filter_urls(table, entries).collect()}
    assert got == {1: (0, None), 2: (1, "bad.example.com"), 3: (1, "bad.example.com"), 4: (0, None),
                   5: (1, "bad.example.com"), 6: (0, None), 7: (1, "x.net/en"), 8: (0, None), 9: (0, None), 10: (0, None),
                   11: (0, None)}
    assert urls.filter_urls(table, entries.limit(0)).where("n_active > 0").count() == 0
    assert urls.filter_urls(table.limit(0), entries).count() == 0


def test_hosts_are_read_as_a_browser_reads_them(spark):
    hosts = {"http://user@bad.example.com/": "bad.example.com", "http://user:pw@bad.example.com:8080/x": "bad.example.com",
             "http://a@b@bad.example.com": "bad.example.com", "http://bad.example.com./a": "bad.example.com",
             "  http://bad.example.com/a": "bad.example.com", "http://bad.example.com ": "bad.example.com",
             "ht\ntp://bad.exa\tmple.com/a": "bad.example.com", "HTTP://BAD.example.COM?q=@good.org": "bad.example.com",
             "http://bad.example.com\\@good.org/": "bad.example.com", "http://good.org/@bad.example.com": "good.org",
             "http://[::1]:80/x": "[::1]", "http:///x": None, "http://...": None, "//bad.example.com": None, "": None,
             "http://" + "a." * 4000 + "com/" + "x" * 50000: "a." * 4000 + "com"}
    table = spark.createDataFrame(list(hosts.items()), "url string, want string")
    for r in table.select("url", "want", urls.host_of(F.col("url")).alias("got")).collect():
        assert r.got == r.want, r.url


def test_captures_are_told_by_id_url_and_day(spark):
    entries = spark.createDataFrame([("bad.example.com", 10, "add"), ("bad.example.com", 20, "remove")],
                                    "pattern string, day int, action string")
    captures = [(None, "http://bad.example.com/a", 12), (None, "http://bad.example.com/b", 12), (1, "http://bad.example.com/", 12),
                (1, "http://bad.example.com/", 25), (1, "http://good.org/", 12), (2, None, 12), (3, "http://bad.example.com/", None),
                (4, "http://bad.example.com/", 12), (4, "http://bad.example.com/", 12)]
    # Extra columns that clash with names used inside.
    table = spark.createDataFrame([(*c, 7, "z") for c in captures], "id long, url string, day int, copies int, pattern string")
    got = Counter(map(tuple, urls.filter_urls(table, entries).collect()))
    assert got == Counter([(None, 12, 1, "bad.example.com")] * 2 + [
        (1, 12, 1, "bad.example.com"), (1, 25, 0, None), (1, 12, 0, None), (2, 12, 0, None), (3, None, 0, None),
        (4, 12, 1, "bad.example.com")])


def _licences(text):
    """Every label with a share of 0.8 or more where its key phrase stands, by brute force."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text))
    found = {}
    for label, template, key in licenses.TEMPLATES:
        t, k = template.split(), key.split()
        at = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
        for s in range(-at, len(w)):
            if w[s + at:s + at + len(k)] == k:
                share = sum(0 <= s + i < len(w) and w[s + i] == x for i, x in enumerate(t)) / len(t)
                if share >= 0.8:
                    found[label] = max(share, found.get(label, 0))
    return w, found


def _licence_texts():
    rnd = random.Random(9)
    filler = ["software", "the", "and", "license", "tree", "of", "river", "to", "public", "is"]
    texts = ["This library is distributed under the MIT license.", "provided under the MIT license",
             "Permission is hereby granted, free of charge, to every person obtaining a copy of this software",
             "This work is made available under the GNU General Public License, version 3.",
             "licensed under the GNU General Public License version 2", "mit license", "under the mit license",
             "software " * 3000 + "released under the mit license " * 2]
    for _, template, key in licenses.TEMPLATES:           # every number of changed words around the limit
        t, k = template.split(), key.split()
        at = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
        free = [i for i in range(len(t)) if not at <= i < at + len(k)]
        for changed in range(min(len(free), len(t) // 5 + 2) + 1):
            for _ in range(3):
                w = list(t)
                for i in rnd.sample(free, changed):
                    w[i] = rnd.choice(filler)
                texts.append(" ".join([*rnd.choices(filler, k=rnd.randint(0, 6)), *w, *rnd.choices(filler, k=4)]))
        texts += [" ".join(t[1:]), " ".join(t[:-1]), " ".join(t[len(t) // 5:])]      # cut off at the text's ends
    return texts


def test_license_scan(docs, nothing):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in licenses.scan(docs).collect():
        w, found = _licences(texts[r.row.doc_id])
        places = sorted((i, label) for phrase, label in licenses.BASE.items() for p in (phrase.split(),)
                        for i in range(len(w)) if w[i:i + len(p)] == p)
        assert (r.n_words, sorted((p["at"], p["label"]) for p in r.places)) == (len(w), places)
        assert {f["label"]: f["share"] for f in r.found} == found
    assert licenses.scan(nothing).count() == 0


def test_every_share_from_four_fifths_is_found_whatever_other_documents_hold(spark):
    texts = _licence_texts()
    wanted = {i: _licences(t)[1] for i, t in enumerate(texts)}
    assert [sorted(wanted[i]) for i in range(7)] == [["mit"], ["mit"], ["mit-text"], ["gpl-3.0"], [], [], ["mit"]]
    assert len({round(s, 3) for f in wanted.values() for s in f.values()}) > 10
    rows = [(i, t) for i, t in enumerate(texts)]
    # Unrelated documents turn the order of rarity round.
    others = [(-1 - i, "released mit permission hereby granted apache gnu mozilla " * (1 + i % 3)) for i in range(200)]
    for table in (rows, rows + others):
        out = licenses.scan(spark.createDataFrame(table, "doc_id long, text string"))
        assert {r.row.doc_id: {f["label"]: f["share"] for f in r.found} for r in out.collect()
                if r.row.doc_id >= 0} == wanted


def test_pipeline_stages(spark, docs, nothing, tmp_path):
    import corpus_pipeline as C
    spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(0, 0, 0)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    for table in (nothing, docs):
        now = table
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, now, str(tmp_path))
            assert out.columns == table.columns, name
            out.write.parquet(str(tmp_path / f"{name}-{table is docs}"))
            now = spark.read.parquet(str(tmp_path / f"{name}-{table is docs}"))
        pieces = C.STAGES[-1][1](spark, now, str(tmp_path))
        assert pieces.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()
    ids = [r.doc_id for r in now.collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and len(ids) > 20


def _brute_components(texts, width, percent):
    sets = {}
    for d, t in texts.items():
        w = re.findall(WORD, _lower(t))
        sets[d] = frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)] if w else [])
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if b < a and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


def test_near_copies_stage_takes_five_words_and_four_fifths(spark):
    """Copies that three words and 0.9 do not link go; others stay."""
    import corpus_pipeline as C
    workers_import(spark, E.ROOT)
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdeilnorst") for _ in range(6)) for _ in range(3000)]
    texts = []
    for n in (6, 12, 20, 28, 50, 50, 90, 150, 320, 700):
        own = [rnd.choice(words) for _ in range(n)]
        texts.append(own)
        for changes in (1, 1, 2, 3, n // 40 + 1, n // 25 + 1):
            near = list(own)
            for _ in range(changes):
                near[rnd.randrange(n)] = rnd.choice(words)
            texts.append(near)
        texts += [own[n // 8:], own[n // 4:]]
    texts = {i: " ".join(t) for i, t in enumerate(texts)}
    want, strict = (_brute_components(texts, *rule) for rule in ((5, 80), (3, 90)))
    docs = spark.createDataFrame([(d, t) for d, t in texts.items()], "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in C.one_of_each(spark, docs, "").collect()}
    assert kept == set(want.values())
    assert len(kept) < len(set(strict.values())) - 5
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert got == strict


def test_near_copies_stage_judges_rows_not_ids(spark):
    import corpus_pipeline as C
    workers_import(spark, E.ROOT)
    rnd = random.Random(9)
    a, b, c, d = (" ".join("".join(rnd.choice("abcdeilnorst") for _ in range(6)) for _ in range(30)) for _ in range(4))
    rows = [(1, a), (5, a), (5, b), (6, c), (6, d), (7, c), (8, d), (8, d), (9, None), (9, None), (None, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    kept = Counter(tuple(r) for r in C.one_of_each(spark, docs, "").collect())
    assert kept == Counter([(1, a), (5, b), (6, c), (6, d), (9, None), (None, a), (None, a)])


def test_entry_registers_one_query_per_operator():
    names = E.queries()
    assert {n for n in names if re.match(r"op\d+_", n)} == {
        "op1_quality", "op2_topk", "op3_url_filters", "op4_jaccard_join", "op5_bpe", "op6_packing", "op7_language_id",
        "op8_neighbours", "op9_substring_dedup", "op10_licenses"}
    assert "pipeline" in names
