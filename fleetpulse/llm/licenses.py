"""License scans with a positional index of rare words, in DataFrame
operations only.

Licence templates are word sequences with a mandatory key phrase; a label
may have several. Document frequencies of all template words are counted over
all documents, and the index posts every template word with its place.

A file looks up its own highest-IDF licence words: of the template's places
whose words the file holds (fewer than the least share of the template: the
template is out), the rarest ones, as many as a start of that share can
miss and ``VOTES`` more. Each of their places in the file proposes a start
(its place less the template's), and starts on which ``VOTES`` of them agree
are checked: the key phrase must stand word for word, and the share of the
template's words at their places is the score, at least ``SHARE``. No start of that
share is lost, whatever the IDF, so other documents change the work and
never a label.

Everything happens within a row (arrays and higher-order functions), so
nothing is shuffled but the counts of the template words, which combine
before the shuffle. Only files that hold the words of some phrase at all go
through the word arrays' positions.

Base phrases are found wherever their words stand consecutively. Defined
cases: null and empty texts have no words and no labels; repeated rows are
scanned row by row; with no file at all every word is equally rare; ties of
IDF go to the earlier place, a label takes the best share of its templates and starts;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Phrases and labels of the base scan.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Fixed values: (label, template, mandatory key phrase) of public licences, words separated by blanks.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2.0",
     "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
     "on an as is basis without warranties or conditions of any kind either express or implied see the license for "
     "the specific language governing permissions and limitations under the license",
     "without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use"),
    ("bsd",
     "redistributions of source code must retain the above copyright notice this list of conditions and the following "
     "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and "
     "the following disclaimer in the documentation and or other materials provided with the distribution",
     "must reproduce the above copyright notice"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-3.0",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 3 of the license or at your option any "
     "later version", "either version 3 of the license"),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies",
     "with or without fee is hereby granted"),
    ("mit", "released under the mit license", "mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted"),
    ("mit-text",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions of the software",
     "permission is hereby granted"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software released into the public domain"),
]
SHARE, FIFTHS, VOTES = 0.8, 4, 2        # least share (and as fifths), anchors that must agree on a start
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
VOCABULARY = sorted({w for _, t, _ in TEMPLATES for w in t.split()})


def strings(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def least(words: int) -> int:
    """Places that must agree for a share of ``SHARE``."""
    return -(-words * FIFTHS // 5)


def with_words(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    low = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    return (docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), low.alias("low"))
            .select("row", "low", F.array_remove(F.split("low", SEPARATORS), "").alias("w")))


def rarity(words: DataFrame) -> dict[str, int]:
    """Documents that hold each template word, over all documents."""
    seen = words.select(F.explode(F.array_intersect("w", strings(VOCABULARY))).alias("word"))
    return {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}   # at most the templates' words


def by_rarity(df: dict[str, int], template: list[str]) -> list[int]:
    """The template's places, those of its words of highest IDF first."""
    return sorted(range(len(template)), key=lambda i: (df.get(template[i], 0), i))


def _stands(w: Column, at: Column, phrase: list[str]) -> Column:
    out = F.lit(True)
    for i, word in enumerate(phrase):
        out = out & F.coalesce(F.get(w, at + i) == word, F.lit(False))
    return out


def _anchors(template: list[str], df: dict[str, int]) -> Column:
    """(word, place): the file's rarest words of the template; as many as a
    start of the least share can miss, and ``VOTES`` more."""
    places = F.array(*[F.struct(F.lit(template[i]).alias("word"), F.lit(i).alias("place"))
                       for i in by_rarity(df, template)])
    held = F.filter(places, lambda p: F.array_contains("words", p["word"]))
    spare = F.size(held) - least(len(template))
    return F.when(spare >= 0, F.slice(held, 1, F.greatest(spare, F.lit(0)) + VOTES))


def _share(template: list[str], phrase: list[str], anchors: Column) -> Column:
    """Best share of the template at a start on which anchors agree and where
    its key phrase stands (null: there is none)."""
    offset = next(i for i in range(len(template)) if template[i:i + len(phrase)] == phrase)
    w = F.col("w")
    proposed = F.array_sort(F.flatten(F.transform(anchors, lambda a: F.transform(
        F.filter("hits", lambda h: h["word"] == a["word"]), lambda h: h["at"] - a["place"]))))
    # An anchor proposes a start once, so a start that stands VOTES times in the sorted array has their votes.
    agreed = F.filter(F.transform(proposed, lambda s, i: F.struct(
        s.alias("s"), (F.get(proposed, i + (VOTES - 1)) == s).alias("ok"))), lambda p: p["ok"])
    checked = F.filter(F.array_distinct(F.transform(agreed, lambda p: p["s"])),
                       lambda s: (s + offset >= 0) & _stands(w, s + offset, phrase))

    def share(s: Column) -> Column:
        cut = F.greatest(-s, F.lit(0))                   # places before the text's first word
        same = F.zip_with(F.slice(w, s + cut + 1, F.lit(len(template)) - cut),
                          F.slice(strings(template), cut + 1, F.lit(len(template))),
                          lambda a, b: F.coalesce(a == b, F.lit(False)))
        return F.size(F.filter(same, lambda ok: ok)) / F.lit(float(len(template)))

    return F.array_max(F.transform(checked, share))


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(row, n_words, places, labels found with their shares)."""
    words = with_words(docs, text_col, list(keep))
    df = rarity(words)
    first = {p.split()[0]: p.split() for p in BASE}
    # A file without all the words of any phrase can hold none.
    possible = F.lit(False)
    for phrase in [*BASE, *(key for _, _, key in TEMPLATES)]:
        holds = F.lit(True)
        for word in phrase.split():
            holds = holds & F.contains("low", F.lit(word))
        possible = possible | holds
    held = words.select("row", "w", F.when(possible, F.array_intersect("w", strings(VOCABULARY))).alias("words"))
    looked = held.select("row", "w", *[_anchors(t.split(), df).alias(f"anchors{i}")
                                       for i, (_, t, _) in enumerate(TEMPLATES)], F.isnotnull("words").alias("possible"))
    anchors = [f"anchors{i}" for i in range(len(TEMPLATES))]
    none = F.array().cast("array<struct<word:string,place:int>>")
    rare = F.array_union(F.transform(F.concat(*[F.coalesce(a, none) for a in anchors]), lambda a: a["word"]),
                         strings(sorted(first)))
    looked = looked.select("*", F.when(F.col("possible"), rare).alias("rare"))
    marked = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("at"), x.alias("word"))),
                      lambda h: F.array_contains("rare", h["word"]))
    hits = looked.select("row", "w", *anchors, F.when(F.col("possible"), marked).alias("hits"))

    def base_label(h: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, label in BASE.items():
            out = F.when((h["word"] == phrase.split()[0]) & _stands(F.col("w"), h["at"], phrase.split()),
                         F.lit(label)).otherwise(out)
        return out

    places = F.filter(F.transform("hits", lambda h: F.struct(h["at"].alias("at"), base_label(h).alias("label"))),
                      lambda p: p["label"].isNotNull())
    shares: dict[str, list[Column]] = {}
    for i, (label, template, phrase) in enumerate(TEMPLATES):
        shares.setdefault(label, []).append(_share(template.split(), phrase.split(), F.col(anchors[i])))
    found = F.array(*[F.struct(F.lit(label).alias("label"), F.array_max(F.array(*of)).alias("share"))
                      for label, of in sorted(shares.items())])
    passed = F.filter(found, lambda f: f["share"] >= SHARE)
    empty = F.array().cast("array<struct<at:int,label:string>>")
    return hits.select("row", F.size("w").cast("long").alias("n_words"), F.coalesce(places, empty).alias("places"),
                       F.when(F.col("hits").isNotNull(), passed)
                       .otherwise(F.array().cast("array<struct<label:string,share:double>>")).alias("found"))


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
