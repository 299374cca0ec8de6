"""Registered queries of the corpus operators, and the SQL they are held
against where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetpulse.llm import (bpe, collocations, conversations, hnsw, jaccard, langid, licenses, neighbours, packing,
                            quality, substring, topk, urls)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    forest = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.scored(docs, forest, ["doc_id"]).select(
        "row.doc_id", quality.held_out("row.doc_id", 5, 0).alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture, fetched on a day told by its URL, against a
    dated list over the pages' own hosts."""
    captures = _table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url", urls.number(F.col("url"), "fetched", 365).alias("day"))
    out = urls.filter_urls(captures, urls.dated_entries(captures))
    return out.select(F.col("id").alias("page_id"), F.col("day").alias("fetch_day"), "n_active", "rule",
                      (F.col("n_active") > 0).alias("blocked"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(_table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predicted(docs, langid.fit(docs), ["doc_id"]).select(
        "row.doc_id", quality.held_out("row.doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(_table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(_table(spark, sf_dir, "documents"))
    base = F.transform("places", lambda p: p["label"])
    more = F.transform("found", lambda f: f["label"])
    return out.select(
        "row.doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["at"])).cast("long").alias("last_word"),
        licenses.joined(base).alias("base_labels"), licenses.joined(F.concat(base, more)).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0)).alias("score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.ranked(collocations.mine(_table(spark, sf_dir, "documents")))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(conversations.damaged(_table(spark, sf_dir, "conversations")))


def op13_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_topk": op2_topk,
    "op3_url_filters": op3_url_filters,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_bpe": op5_bpe,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_neighbours": op8_neighbours,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_licenses": op10_licenses,
    "op11_collocations": op11_collocations,
    "op12_conversations": op12_conversations,
    "op13_hnsw": op13_hnsw,
}

SQL = {
    "op3_url_filters": urls.SQL,
    "op11_collocations": collocations.SQL,
    "op2_topk": """
        WITH v AS (SELECT vec_id, row_number() OVER () AS r, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
                   FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
             k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM k WHERE rank <= 5""",
}
