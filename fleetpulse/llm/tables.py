"""Staged tables in the cluster's shared folder, and components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from fleetpulse.session import shared_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts the lineage,
    survives lost executors, and gives joins a table they may split when a
    key is hot."""
    return _staged(df, name, None)


def staged_texts(df: DataFrame, name: str) -> DataFrame:
    """The same for whole texts: they are packed more tightly."""
    return _staged(df, name, "zstd")


def _staged(df: DataFrame, name: str, compression: str | None) -> DataFrame:
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def with_fields(df: DataFrame, column: str, fields: str) -> StructType:
    """The schema of one column of ``df`` followed by ``fields`` (a DDL list)."""
    return StructType([df.schema[column], *StructType.fromDDL(fields).fields])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node of ``links`` the smallest node that it
    reaches. Rounds of contraction: each node takes the smallest neighbour
    (or itself), chains are shortened by joining the table with itself, and
    links between the new roots go to the next round. Every round ends in a
    staged table; a hub's links are combined before they are shuffled."""
    links = staged(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                   .where("a < b").distinct(), "links")
    labels = None
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                      .select("node", F.least("node", "low").alias("root")), "hooks")
        if step.isEmpty():
            break
        while True:         # follow chains: the root of a node's root
            up = step.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
            jumped = step.join(up, F.col("root") == F.col("n2"), "left") \
                .select("node", "root", F.coalesce("r2", "root").alias("next"))
            more = staged(jumped, "jumps")
            moved = not more.where("next < root").isEmpty()
            step = more.select("node", F.col("next").alias("root"))
            if not moved:
                break
        if labels is None:
            labels = step
        else:
            new = step.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
            labels = staged(labels.join(new, F.col("root") == F.col("n2"), "left")
                            .select("node", F.coalesce("r2", "root").alias("root")), "labels")
        to_a = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        to_b = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = staged(links.join(to_a, "a").join(to_b, "b")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                       .where("a < b").distinct(), "links")
        if links.isEmpty():
            break
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
