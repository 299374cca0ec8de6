"""Approximate nearest neighbours by cosine: one hierarchical navigable
small-world graph per shard.

Rows with equal vectors are one node, which carries the few smallest of its
rows (as many as an answer can hold); a vector that a third of all rows share
costs one node. Nodes are dealt to shards by hash, separately for every vector
length, about ``SHARD`` nodes each; a task builds one shard's graph and stores
it as flat arrays: the vectors, the neighbours of the ground layer (a fixed
number per node, -1 where free), and the same per upper layer. The graphs are a
table in the shared folder, so a lost executor costs a shard's build at most.

Searching cuts the queries' distinct vectors into blocks; every block meets
every graph of its vector length once (a stated query set against all rows, in
blocks), and the shards' best are merged by (score, id). Scores are cosines of
the original vectors in double precision.

Recall depends on ``LINKS``, ``BUILD`` and ``SEARCH`` (list lengths while
building and searching); ``recall`` measures it against all rows. On the given
tables it is above 0.99.

Defined cases: vectors that are null, zero or hold null or non-finite
components, and null ids, take no part; rows that repeat an id are candidates
of their own, and queries of their own; only vectors of equal length meet; with
fewer than k others all that are found are returned; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetpulse.llm.tables import staged
from fleetpulse.llm.textcore import U, mix

SHARD = 8192            # nodes in a graph
LINKS = 16              # neighbours on an upper layer; twice as many on the ground
BUILD, SEARCH = 64, 200
BLOCK = 2048            # queries that meet a graph at once
GRAPH = "vectors binary, ids binary, ground binary, layers array<binary>, members array<binary>, entry int"


class Graph:
    """A navigable small-world graph over unit vectors."""

    def __init__(self, unit: np.ndarray, ground: np.ndarray, members: list[np.ndarray], layers: list[np.ndarray],
                 entry: int):
        self.unit, self.ground, self.members, self.layers, self.entry = unit, ground, members, layers, entry
        # Upper layers name nodes by their place in the shard; ``slot`` finds a node's row there.
        self.slots = [{int(m): i for i, m in enumerate(of)} for of in members]
        self.stamp = np.zeros(len(unit), np.int64)
        self.now = 0

    def links(self, layer: int, node: int) -> np.ndarray:
        row = self.ground[node] if layer == 0 else self.layers[layer - 1][self.slots[layer - 1][node]]
        return row[row >= 0]

    def near(self, q: np.ndarray, start: list[tuple[float, int]], layer: int, width: int) -> list[tuple[float, int]]:
        """The ``width`` nearest nodes met from ``start``, best first, as
        (minus cosine, node)."""
        self.now += 1
        stamp, now, unit = self.stamp, self.now, self.unit
        stamp[[n for _, n in start]] = now
        ahead = list(start)
        heapq.heapify(ahead)
        best = [(-d, n) for d, n in start]
        heapq.heapify(best)
        while ahead:
            d, node = heapq.heappop(ahead)
            if len(best) >= width and d > -best[0][0]:
                break
            row = self.links(layer, node)
            row = row[stamp[row] != now]
            if not len(row):
                continue
            stamp[row] = now
            away = -(unit[row] @ q)
            if len(best) >= width:
                closer = away < -best[0][0]
                row, away = row[closer], away[closer]
            for x, n in zip(away.tolist(), row.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-x, n))
                    heapq.heappush(ahead, (x, n))
                elif x < -best[0][0]:
                    heapq.heapreplace(best, (-x, n))
                    heapq.heappush(ahead, (x, n))
        return sorted((-x, n) for x, n in best)

    def descend(self, q: np.ndarray, to: int) -> list[tuple[float, int]]:
        at = [(-float(self.unit[self.entry] @ q), self.entry)]
        for layer in range(len(self.members), to, -1):
            at = self.near(q, at, layer, 1)
        return at

    def search(self, q: np.ndarray, k: int, width: int) -> list[int]:
        return [n for _, n in self.near(q, self.descend(q, 0), 0, max(k, width))[:k]]


def spread(unit: np.ndarray, found: list[tuple[float, int]], most: int) -> list[int]:
    """Neighbours to keep of ``found`` (nearest first): one that is nearer to a
    neighbour already kept than to the node waits; places left go to those
    that waited, nearest first."""
    if len(found) <= most:
        return [n for _, n in found]
    ids = np.fromiter((n for _, n in found), np.int64, len(found))
    own = np.fromiter((d for d, _ in found), float, len(found))
    rows = unit[ids]
    nearest = np.full(len(ids), np.inf)
    kept: list[int] = []
    for i in range(len(ids)):
        if nearest[i] > own[i]:
            kept.append(i)
            if len(kept) == most:
                break
            np.minimum(nearest, -(rows @ rows[i]), out=nearest)
    if len(kept) < most:
        chosen = set(kept)
        kept += [i for i in range(len(ids)) if i not in chosen][:most - len(kept)]
    return ids[kept].tolist()


def build(unit: np.ndarray, keys: np.ndarray, links: int = LINKS, width: int = BUILD) -> Graph:
    """Insert the rows of ``unit`` one by one; a node's layer is told by the
    hash of its key, so a task that runs again builds the same graph."""
    n = len(unit)
    u = (mix(keys.astype(U) + U(0x9E3779B97F4A7C15)) >> U(11)).astype(float) / 2.0 ** 53
    level = np.minimum(-np.log(np.maximum(u, 2.0 ** -53)) / math.log(links), 30).astype(int)
    top = int(level.max()) if n else 0
    members = [np.flatnonzero(level >= l) for l in range(1, top + 1)]
    graph = Graph(unit, np.full((n, 2 * links), -1, np.int32), members,
                  [np.full((len(m), links), -1, np.int32) for m in members], 0)
    reached = int(level[0]) if n else 0

    def rows_of(layer: int):
        if layer == 0:
            return graph.ground, lambda node: node
        return graph.layers[layer - 1], graph.slots[layer - 1].__getitem__

    for node in range(1, n):
        q, l = unit[node], int(level[node])
        at = [(-float(unit[graph.entry] @ q), graph.entry)]
        for layer in range(reached, l, -1):
            at = graph.near(q, at, layer, 1)
        for layer in range(min(l, reached), -1, -1):
            at = graph.near(q, at, layer, width)
            table, slot = rows_of(layer)
            mine = spread(unit, at, links)
            table[slot(node), :len(mine)] = mine
            for other in mine:
                row = table[slot(other)]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                else:
                    ids = np.append(row, node)
                    away = -(unit[ids] @ unit[other])
                    order = np.argsort(away, kind="stable")
                    # Down to three quarters: a full row is thinned once in several additions.
                    less = spread(unit, list(zip(away[order].tolist(), ids[order].tolist())), len(row) * 3 // 4)
                    row[:len(less)], row[len(less):] = less, -1
        if l > reached:
            graph.entry, reached = node, l
    return graph


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that neither tiny nor huge vectors lose their length.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def rows_of(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, row, v, node): rows that take part, each with a key of its own,
    and a key of the vector that equal vectors share."""
    valid = vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vector_col).cast("array<double>").alias("v")).where(
        "id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
        "and exists(v, x -> x <> 0)")
    v = F.transform("v", lambda x: x + F.lit(0.0))                   # -0.0 is 0.0
    out = valid.select("id", F.monotonically_increasing_id().alias("row"), v.alias("v"))
    return staged(out.withColumn("node", F.unhex(F.sha2(F.to_json("v"), 256))), "rows")


def index(rows: DataFrame, keep: int, shard: int = SHARD) -> DataFrame:
    """(dims, shard, shards, holds, graph): one row per graph. ``holds``:
    for every node the ``keep`` smallest (id, row) of its rows."""
    least = F.row_number().over(Window.partitionBy("node").orderBy("id", "row"))
    nodes = staged(rows.withColumn("place", least).where(F.col("place") <= keep).groupBy("node").agg(
        F.first("v").alias("v"), F.array_sort(F.collect_list(F.struct("id", "row"))).alias("holds"))
        .withColumn("dims", F.size("v")), "nodes")
    sizes = nodes.groupBy("dims").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    dealt = nodes.join(sizes, "dims").withColumn("key", F.xxhash64("node")) \
        .withColumn("shard", F.pmod("key", "shards").cast("int"))
    # Building is long for the few bytes a shard has: partitions by the number of shards, not by their size.
    total = sizes.agg(F.sum("shards")).first()[0] or 1
    dealt = dealt.repartition(4 * total, "dims", "shard")

    def make(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dims, no, shards = (x.as_py() for x in key)
        table = table.sort_by("key")
        keys = table.column("key").to_numpy()
        unit = _unit(_matrix(table.column("v"), dims))
        g = build(unit, keys.view(np.uint64))
        holds = table.column("holds").combine_chunks()
        holds = holds.chunk(0) if isinstance(holds, pa.ChunkedArray) else holds
        flat = holds.flatten()
        pairs = np.stack([flat.field("id").to_numpy(), flat.field("row").to_numpy()], axis=1).astype("<i8")
        first = np.zeros(len(holds) + 1, "<i8")
        np.cumsum(pa.compute.list_value_length(holds).to_numpy(zero_copy_only=False), out=first[1:])
        return pa.table({
            "dims": [dims], "shard": [no], "shards": [shards],
            "vectors": [unit.astype("<f8").tobytes()], "ids": [first.tobytes() + pairs.tobytes()],
            "ground": [g.ground.astype("<i4").tobytes()], "layers": [[x.astype("<i4").tobytes() for x in g.layers]],
            "members": [[x.astype("<i4").tobytes() for x in g.members]], "entry": [g.entry]},
            schema=pa.schema([("dims", pa.int32()), ("shard", pa.int32()), ("shards", pa.int32()),
                              ("vectors", pa.binary()), ("ids", pa.binary()), ("ground", pa.binary()),
                              ("layers", pa.list_(pa.binary())), ("members", pa.list_(pa.binary())),
                              ("entry", pa.int32())]))

    out = dealt.groupBy("dims", "shard", "shards").applyInArrow(make, f"dims int, shard int, shards int, {GRAPH}")
    return staged(out, "graphs")


def _loaded(row: dict, dims: int) -> tuple[Graph, np.ndarray, np.ndarray]:
    unit = np.frombuffer(row["vectors"], "<f8").reshape(-1, dims)
    n = len(unit)
    flat = np.frombuffer(row["ids"], "<i8")
    members = [np.frombuffer(m, "<i4") for m in row["members"]]
    layers = [np.frombuffer(x, "<i4").reshape(len(m), -1) for x, m in zip(row["layers"], members)]
    ground = np.frombuffer(row["ground"], "<i4").reshape(n, -1)
    return Graph(unit, ground, members, layers, row["entry"]), flat[:n + 1], flat[n + 1:].reshape(-1, 2)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            width: int = SEARCH, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows where ``is_query`` (a
    condition on column ``id``) holds, against all other rows."""
    rows = rows_of(vectors, id_col, vector_col)
    graphs = index(rows, k + 1, shard)                  # one more than k, as a query's own row may be among them
    queries = rows.where(is_query)
    asked = queries.groupBy("node").agg(F.first("v").alias("v")).withColumn("dims", F.size("v"))
    counts = asked.groupBy("dims").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    shards = graphs.groupBy("dims").agg(F.max("shards").alias("shards"))
    series = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    blocks = (asked.join(counts, "dims").join(shards, "dims")
              .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
              .withColumn("shard", series("shards")).select("dims", "shard", "block", "node", "v"))
    met = graphs.join(counts, "dims").withColumn("block", series("blocks")).drop("blocks", "shards")

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        dims = key[0].as_py()
        node, vec, row, score = [], [], [], []
        if left.num_rows and right.num_rows:
            graph, first, pairs = _loaded(right.to_pylist()[0], dims)
            names = left.column("node").to_pylist()
            for name, q in zip(names, _unit(_matrix(left.column("v"), dims))):
                near = graph.search(q, k + 1, width)
                exact = graph.unit[near] @ q
                for place, s in zip(near, exact.tolist()):
                    for i, r in pairs[first[place]:first[place + 1]].tolist():
                        node.append(name), vec.append(i), row.append(r), score.append(s)
        return pa.table({"node": pa.array(node, pa.binary()), "vec_id": pa.array(vec, pa.int64()),
                         "row": pa.array(row, pa.int64()), "score": pa.array(score, pa.float64())})

    found = (blocks.groupBy("dims", "shard", "block").cogroup(met.groupBy("dims", "shard", "block"))
             .applyInArrow(meet, "node binary, vec_id long, row long, score double"))
    order = [F.desc("score"), "vec_id", "row"]
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy(*order))) \
        .where(F.col("place") <= k + 1).groupBy("node").agg(F.collect_list(F.struct("score", "vec_id", "row")).alias("best"))
    # Queries of one vector share its answer; each leaves itself out.
    other = F.filter("best", lambda b: b["row"] != F.col("own"))
    ranked = F.slice(F.array_sort(F.transform(other, lambda b: F.struct(
        (-b["score"]).alias("away"), b["vec_id"].alias("vec_id"), b["row"].alias("row")))), 1, k)
    return (queries.select("node", F.col("id").alias("query_id"), F.col("row").alias("own")).join(best, "node")
            .select("query_id", F.posexplode(ranked).alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    (-F.col("hit.away")).alias("score")))
