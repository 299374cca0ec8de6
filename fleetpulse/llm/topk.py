"""Exact top-k by inner product: columnar branch-and-bound.

Vectors are quantised to floor(256 x). Queries and candidates are cut into
blocks that meet once each (a stated query set against all rows, in blocks).
Within a meeting, candidates lie in vertical layout, one row per dimension,
ordered by the mass that the dimension can add. Scores accumulate dimension
block by dimension block; the mass that remains bounds what is missing
(Cauchy-Schwarz), the k-th best lower bound is the mark to beat, and
candidates whose upper bound lies under it are compacted away. Candidates
that tie with the mark stay, so ties are decided exactly.

Defined cases: null vectors, vectors holding null or non-finite components
and null ids take no part; rows that repeat an id are candidates of their
own, and queries of their own (each leaves out its own row alone); only vectors of equal length meet; with fewer than k others, all are
returned; empty tables give empty results; extra columns are not read.
Scores are exact while they fit 53 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetpulse.llm.tables import staged

CANDIDATES, QUERIES = 8192, 2048       # rows in a block
STEP = 16                              # dimensions in a block


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    column = table.column("v").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def search(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int,
           keys: np.ndarray | None = None):
    """(query index, row index, score) of each query's k best rows in the
    block but its own: ``own`` holds the queries' keys, ``keys`` those of the
    rows (their ids, if not given)."""
    keys = ids if keys is None else keys
    dims = rows.shape[1]
    order = np.argsort(-(queries ** 2).mean(0) * (rows ** 2).mean(0), kind="stable")
    q, vertical = queries[:, order], np.ascontiguousarray(rows[:, order].T)
    cuts = list(range(0, dims, STEP)) + [dims]
    mass = lambda m: np.sqrt(np.concatenate([np.cumsum((m ** 2)[:, ::-1], axis=1)[:, ::-1],
                                             np.zeros((len(m), 1))], axis=1)[:, cuts])
    left_q, left_c = mass(q), np.ascontiguousarray(mass(vertical.T).T)
    out = []
    for i in range(len(q)):
        alive = np.flatnonzero(keys != own[i])
        score = np.zeros(len(alive))
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:]), 1):
            whole = len(alive) == vertical.shape[1]
            score = score + q[i, lo:hi] @ (vertical[lo:hi] if whole else vertical[lo:hi, alive])
            if len(alive) > k and hi < dims:
                slack = left_q[i, b] * left_c[b, alive] * (1 + 1e-9) + 1e-6
                mark = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                stays = score + slack >= mark
                alive, score = alive[stays], score[stays]
        best = np.lexsort((ids[alive], -score))[:k]
        out += [(i, int(alive[j]), float(score[j])) for j in best]
    return out


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` (a
    condition on column ``id``) holds, against all other rows."""
    x = F.col(vector_col).cast("array<double>")
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("v")).where(
        "id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    rows = staged(valid.select("id", F.monotonically_increasing_id().alias("row"),
                               F.transform("v", lambda c: F.floor(c * 256).cast("double")).alias("v"),
                               F.size("v").alias("dims")), "vectors")
    n, m = rows.count(), rows.where(is_query).count()
    c_blocks, q_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))
    block = lambda col, of: F.pmod(F.xxhash64(col), F.lit(of)).cast("int")
    series = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    candidates = rows.withColumn("c", block("row", c_blocks)).withColumn("q", series(q_blocks))
    queries = rows.where(is_query).withColumn("q", block("row", q_blocks)).withColumn("c", series(c_blocks))

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        dims = key[0].as_py()
        qi, ci = left.column("id").to_numpy(), right.column("id").to_numpy()
        own = left.column("row").to_numpy()
        if len(qi) and len(ci):
            found = search(_matrix(left, dims), own, _matrix(right, dims), ci, k, right.column("row").to_numpy())
        return pa.table({"row": pa.array([int(own[f[0]]) for f in found], pa.int64()),
                         "query_id": pa.array([int(qi[f[0]]) for f in found], pa.int64()),
                         "vec_id": pa.array([int(ci[f[1]]) for f in found], pa.int64()),
                         "score": pa.array([int(f[2]) for f in found], pa.int64())})

    best = (queries.groupBy("dims", "q", "c").cogroup(candidates.groupBy("dims", "q", "c"))
            .applyInArrow(meet, "row bigint, query_id bigint, vec_id bigint, score bigint"))
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
