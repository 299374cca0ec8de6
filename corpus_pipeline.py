"""The corpus pipeline: from raw documents to training windows.

Language ID, quality classifier, n-gram Jaccard join, substring dedup,
packing. Every stage takes (spark, docs, sf_dir) and returns a DataFrame;
``run`` writes each result as Parquet into the shared folder and reads it
again as the next stage's documents. All but the last stage return the
columns of their input, whatever they are.

Defined cases: see each operator. Rows with a null id pass the join stage;
of rows that are equal in all columns one stays; rows that share an id but not
their text are documents of their own there; texts emptied by the substring
stage stay as empty documents; empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetpulse.llm import jaccard, langid, packing, quality, substring
from fleetpulse.llm.tables import staged

NEAR = {"width": 5, "percent": 80}   # near copies: words in a shingle, least Jaccard similarity


BATCH_BYTES = 8 << 20      # of texts that travel to a Python worker at once, however long they are


def _bounded(stage):
    """A stage whose Arrow batches are bounded by their bytes, not by rows
    alone: what a worker and its executor hold follows neither the length of
    the texts nor what earlier stages left behind."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)
    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


@_bounded
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is anyone's guess, go."""
    model = langid.fit(docs)
    found = langid.predicted(docs, model, _names(docs))
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= model.floor())).select("row.*")


@_bounded
def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    forest = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, forest, _names(docs)).where(F.col("score") >= quality.THRESHOLD).select("row.*")


@_bounded
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies one row stays, of those with the smallest id."""
    names = _names(docs)
    # Rows that share an id are told apart by what they hold.
    held = F.xxhash64(*names, *[F.col(c).isNull() for c in names])
    keyed = docs.select(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", held.alias("held"))).alias("key"),
                        F.struct(*names).alias("row"))
    told = staged(jaccard.jaccard_components(keyed.select("key", "row.text"), id_col="key", **NEAR).where("key is not null")
                  .groupBy("key").agg(F.count("*").alias("n"), F.min("component_id").alias("low")), "told")
    alone = keyed.join(told.where("n > 1 or low <> key").select("key"), "key", "left_anti").select("row.*")
    several = keyed.join(told.where("n > 1 and low = key").select("key"), "key", "left_semi") \
        .groupBy("key").agg(F.min("row").alias("row")).select("row.*")
    return alone.union(several)


@_bounded
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that occur more than once go; other texts stay as they are."""
    out = substring.remove_repeats(docs, _names(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long"))
    new = {"text": text, "n_chars": F.coalesce(chars, F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if new.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@_bounded
def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in windows of 1024 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("quality", good), ("near_copies", one_of_each), ("repeats", without_repeats),
          ("packing", windows)]
ORACLE_SQL = None   # trained models and hashed windows: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
