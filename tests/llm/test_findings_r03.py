"""Tests of the findings of round 3 on the corpus operators."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from fleetpulse.llm import jaccard, packing, substring, tables
from fleetpulse.llm.bpe_words import ChunkEncoder


def test_a_word_is_encoded_once_whatever_mark_closes_it():
    asked = []

    def encode_chunks(chunks):
        asked.extend(chunks)
        return [np.array([len(c)], "<u4").tobytes() for c in chunks]

    encoder = ChunkEncoder(lambda strings: [np.array([1000 + len(s)], "<u4").tobytes() for s in strings], encode_chunks)
    got = encoder.texts(["a word word, word. word!", "b word; c", ""])
    assert sorted(asked) == [" c", " word"]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
        [1001, 5, 5, 1001, 5, 1001, 5, 1001], [1001, 5, 1001, 2], [1000]]


def test_chunks_remembered_are_bounded_and_forgotten_ones_come_back():
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    worker = packing._worker(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    encoder = ChunkEncoder(worker.encode, worker.encode_chunks, 64)
    for part in [*range(40), *range(10)]:
        texts = [f"le mot{part}x{i}, é{i}.  fin　 don't. {i}. <|endoftext|>. á. ... !" for i in range(9)] + ["", " ", ". ."]
        texts += [f"Word{part} word{i}; word{part}{i}? end." for i in range(9)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.texts(texts)] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.chunks) <= 64 + 60


def test_passages_stay_out_of_lists_where_shingles_crowd_the_counters(spark, monkeypatch):
    rnd = random.Random(11)
    own = lambda n: " ".join("".join(rnd.choices("abcdefghij", k=7)) for _ in range(n))
    passages = [own(40) for _ in range(20)]             # each stands in three texts
    texts = [own(200) + " " + passages[i % 20] for i in range(60)]
    texts.append(texts[0] + " more")
    rows = {}

    def staged(df, name):
        out = tables.staged(df, name)
        rows.setdefault(name, out.count())
        return out

    monkeypatch.setattr(jaccard, "staged", staged)
    monkeypatch.setattr(jaccard, "COUNT_BITS", 10)      # some 14 shingles a counter
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert got == {i: i % 60 for i in range(61)}
    assert rows["postings"] < 130                       # a third of them in lists of the linked sets


def test_repeats_travel_as_runs_and_whole_texts_stay(spark, monkeypatch):
    rnd = random.Random(12)
    own = lambda n: " ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(n))
    passages = [own(300) for _ in range(150)]           # each stands in two of six hundred texts
    texts = [own(700) + (" " + passages[i // 2] if i < 300 else "") for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()
    windows, joined = [], []
    kind = type(docs)
    repartition, join = kind.repartition, kind.join

    def counted(self, *args):
        if "windows" in self.columns or "h1" in self.columns:
            windows.append(self.count())
        return repartition(self, *args)

    def counted_join(self, other, on=None, how=None):
        joined.append(self.count())
        return join(self, other, on, how)

    monkeypatch.setattr(kind, "repartition", counted)
    monkeypatch.setattr(kind, "join", counted_join)
    got = substring.remove_repeats(docs, ["doc_id"]).collect()
    assert {(r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in got} == {
        (i, 1000 if i < 300 else 700, 300 if i < 300 else 0, " ".join(t.split()[:700])) for i, t in enumerate(texts)}
    assert 0 < windows[0] < 150 * 2 * 266 / 4            # of 266 repeated windows a passage
    assert 300 <= joined[0] < 450


def test_windows_that_meet_across_partitions_and_copies(spark):
    rnd = random.Random(13)
    words = [f"w{i}" for i in range(60)]
    own = lambda n: [rnd.choice(words) for _ in range(n)]
    line, passage = own(20), own(90)
    texts = [own(50) + line + own(40) for _ in range(40)]                       # a line shorter than a window
    texts += [own(10) + passage[i:i + 35 + i] + own(10) for i in range(0, 50, 7)]    # parts of one passage, shifted
    texts += [line * 9, passage + passage, passage[:34], [], ["x"] * 36, ["x"] * 34] + 5 * [own(100)] + [own(34)] * 2
    k, starts = 35, Counter()
    for t in texts:
        starts.update(tuple(t[i:i + k]) for i in range(len(t) - k + 1))
    want = []
    for d, t in enumerate(texts):
        gone = {j for i in range(len(t) - k + 1) if starts[tuple(t[i:i + k])] > 1 for j in range(i, i + k)}
        want.append((d, " ".join(w for j, w in enumerate(t) if j not in gone), len(t), len(gone)))
    rows = [(d, " ".join(t)) for d, t in enumerate(texts)]
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = substring.remove_repeats(docs, ["doc_id"], k=k).collect()
        assert sorted((r.row.doc_id, r.kept, r.n_words, r.n_removed) for r in got) == want
    short = substring.remove_repeats(spark.createDataFrame([(0, "a b a"), (1, "c")], "doc_id long, text string"), ["doc_id"], k=1)
    assert sorted((r.row.doc_id, r.kept) for r in short.collect()) == [(0, "b"), (1, "c")]


@pytest.mark.parametrize("copies, passes", [(2, 1), (12, 2)])
def test_lists_that_proposed_all_pairs_are_not_read_again(spark, monkeypatch, copies, passes):
    """Texts in families: linked ones, and pairs too far apart that the sketches let through or not."""
    rnd = random.Random(14)
    own = lambda n: ["".join(rnd.choices("abcdefghij", k=7)) for _ in range(n)]
    texts = []
    for _ in range(30):
        base = own(60)
        for _ in range(copies):
            at = rnd.randrange(5, 55)
            texts.append(" ".join([*base[:at], *own(1), *base[at + 1:]]))       # 55 of 61 shingles: linked to none
        texts.append(" ".join([*base, *own(1)]))
    texts.append(texts[0] + " more")
    lists = []
    # Leaders would unite some of them before.
    monkeypatch.setattr(jaccard, "leader_links", lambda docs, classes, *rest: spark.createDataFrame([], "a binary, b binary"))
    monkeypatch.setattr(jaccard, "_lists", (lambda real: lambda *args: lists.append(1) or real(*args))(jaccard._lists))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    sets = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert got == dict(enumerate(root))
    assert len(lists) == passes
