"""Embedding near-dedup by NN-descent.

Vectors are compared within a label by cosine, in double precision. Equal
vectors are one node. A first neighbour graph comes from ``TREES`` or more random
sign signatures, with bits by the number of the label's own nodes: nodes of
one signature, ordered along a further random direction, are compared in runs
of ``RUN``. Then the graph is refined: the
neighbours of a node (its list and the lists that it stands in) are joined
with one another, and every node keeps its best ``k``. Links (cosine of at
least the threshold) are kept whenever they are met, beside the lists.

A list whose last entry still reaches the threshold is saturated: it cannot
show all links. Saturated or not, a link never leaves its component, so the
list of a node is enlarged to its whole component: components are compared
in blocks of ``BLOCK`` nodes, which counts every link exactly without a row
for each pair.

Every label takes this way, whatever its size. The audit plants copies of nodes
chosen by a hash (a quarter of a label's nodes, at most about ``AUDIT``) at a
cosine barely over the threshold, the hardest links there are, and lets the
graph find them: a label is done when ``RECALL`` of them are linked to
their origin. So the audit costs the same with many links, few or none. Until
then the label gets fresh trees, more of them the more bits they have, its lists
double, and refinement goes on. Links of planted copies are dropped in the end. Labels
that are not done after ``ROUNDS`` rounds are compared whole, in blocks.

Defined cases: rows with a null label, a null or zero vector, or null or
non-finite components link with nothing; vectors of different lengths never
link; repeated rows count as vectors of their own; ids that are null stay
null; empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleetpulse.llm.tables import components, staged

TREES, RUN, BLOCK, AUDIT, RECALL, ROUNDS = 8, 128, 256, 200, 0.98, 4
PLANTED = "p"       # begins the names of planted copies; names of nodes begin with a digit
NODE = "node string, label string, v binary"


def _unit(data: list[bytes]) -> np.ndarray:
    m = np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def _pairs(a: list, b: list, sim: list) -> pa.RecordBatch:
    return _rows({"a": (a, pa.string()), "b": (b, pa.string()), "sim": (sim, pa.float64())})


def _best(nodes: list[str], m: np.ndarray, keep: int, out: tuple[list, list, list]) -> None:
    """Append each node's ``keep`` best others (equals of the last included)."""
    sims = m @ m.T
    np.fill_diagonal(sims, -2)
    n = len(nodes)
    if n < 2:
        return
    keep = min(keep, n - 1)
    cut = np.partition(sims, n - keep, axis=1)[:, n - keep]
    for i, j in zip(*np.nonzero(sims >= cut[:, None])):
        out[0].append(nodes[i])
        out[1].append(nodes[j])
        out[2].append(float(sims[i, j]))


def _grouped(batches: Iterator[pa.RecordBatch], key: list[str]):
    """Rows of sorted batches as (key, lists), group by group."""
    now, held = None, None
    for batch in batches:
        cols = batch.to_pydict()
        for row in zip(*cols.values()):
            r = dict(zip(cols, row))
            k = tuple(r[c] for c in key)
            if k != now:
                if held:
                    yield now, held
                now, held = k, []
            held.append(r)
    if held:
        yield now, held


def _forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (first, second) that leave the components of a block as they
    are, with places of rows and then of columns."""
    n = len(hit)
    low = np.arange(n + hit.shape[1])
    while True:
        rows = np.minimum(low[:n], np.where(hit, low[n:][None], len(low)).min(axis=1, initial=len(low)))
        cols = np.minimum(low[n:], np.where(hit, rows[:, None], len(low)).min(axis=0, initial=len(low)))
        new = np.concatenate([rows, cols])
        if (new == low).all():
            first = np.flatnonzero(low != np.arange(len(low)))
            return first, low[first]
        low = new


def with_bits(classes: DataFrame) -> DataFrame:
    """``bits`` of the signatures of a class of ``n`` nodes: leaves of about half a run."""
    return classes.withColumn("bits", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / (RUN / 2)))).cast("int"))


def perturbed(node: str, v: bytes, cosine: float) -> bytes:
    """A copy of ``v`` at this cosine, in a direction told by the node's name
    (in one dimension: an equal one)."""
    x = np.frombuffer(v, "<f8")
    x = x / np.sqrt(x @ x)
    seed = int.from_bytes(blake2b(node.encode(), digest_size=8).digest(), "little")
    w = np.random.default_rng(seed).standard_normal(len(x))
    w -= (w @ x) * x
    size = np.sqrt(w @ w)
    return (cosine * x + (np.sqrt(1 - cosine * cosine) * w / size if size > 1e-9 else 0)).astype("<f8").tobytes()


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, k: int = 8, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"),
                          F.col(label_col).cast("string").alias("label"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, data = [], []
            for x, label in zip(batch.column("x").to_pylist(), batch.column("label").to_pylist()):
                v = None
                if label is not None and x and None not in x:
                    m = np.array(x) + 0.0                     # -0.0 becomes 0.0
                    if np.isfinite(m).all() and m.any():
                        m = m / np.abs(m).max()               # keeps squares in range
                        v = m.astype("<f8").tobytes()
                data.append(v)
                node.append(None if v is None else f"{len(x)}-" + blake2b(
                    label.encode() + b"\0" + v, digest_size=16).hexdigest())
            yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array(node, pa.string()),
                                   pa.array(data, pa.binary())], names=["id", "label", "node", "v"])

    table = staged(rows.mapInArrow(keyed, f"id {kind}, label string, node string, v binary"), "vectors")
    nodes = staged(table.where("node is not null").groupBy("node")
                   .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("low"),
                        F.count("*").alias("copies")), "nodes")
    # Only nodes of one label and length are compared: each such class has bits by its own size.
    classes = staged(with_bits(nodes.groupBy("label", F.length("v").alias("bytes"))
                               .agg(F.count("*").alias("n"), F.min("node").alias("first"))), "classes")
    sized = nodes.select("node", "label", "v", F.length("v").alias("bytes")).join(classes, ["label", "bytes"])
    cosine = min(1.0, threshold + (1 - threshold) / 10)       # of a planted copy and its origin

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, v = batch.column("node").to_pylist(), batch.column("v").to_pylist()
            yield batch.set_column(0, "node", pa.array([PLANTED + x for x in node], pa.string())) \
                .set_column(1, "v", pa.array([perturbed(x, d, cosine) for x, d in zip(node, v)], pa.binary()))

    one = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(1 << 30)) / float(1 << 30)
    sets = ["label", "bytes"]
    cols = ["node", "v", *sets, "bits"]
    origins = sized.where((F.col("n") > 1) & ((one < F.least(F.lit(0.25), AUDIT / F.col("n"))) | (F.col("node") == F.col("first"))))
    planted_nodes = staged(origins.select(*cols).mapInArrow(plant, origins.select(*cols).schema), "planted")
    audited = sized.where("n > 1").select(*cols).union(planted_nodes)

    def planted(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, depth = batch.column("v").to_pylist(), batch.column("bits").to_pylist()
            for size, bits in sorted({(len(d), b) for d, b in zip(data, depth)}):
                at = [i for i, d in enumerate(data) if len(d) == size and depth[i] == bits]
                m = _unit([data[i] for i in at])
                part = batch.take(pa.array(at))
                for tree in (turn * 64 + k for k in range(max(TREES, bits))):
                    plane = np.random.default_rng([size, tree]).standard_normal((m.shape[1], bits + 1))
                    p = m @ plane
                    sign = (p[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(at), int)
                    yield pa.record_batch([
                        pa.array([f"{size}-{tree}-{s}" for s in sign.tolist()]), pa.array(p[:, bits]),
                        part.column("node"), part.column("label"), part.column("v")],
                        names=["leaf", "along", "node", "label", "v"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Consecutive nodes of a leaf, RUN at a time; the streams are sorted."""
        now, held = None, []
        out = ([], [], [])
        def close():
            if len(held) > 1:
                _best([h[0] for h in held], _unit([h[1] for h in held]), k, out)
        for batch in batches:
            for label, leaf, node, v in zip(*(batch.column(c).to_pylist() for c in ("label", "leaf", "node", "v"))):
                if (label, leaf) != now or len(held) == RUN:
                    close()
                    now, held = (label, leaf), []
                held.append((node, v))
            if out[0]:
                yield _pairs(*out)
                out = ([], [], [])
        close()
        if out[0]:
            yield _pairs(*out)

    order = Window.partitionBy("a").orderBy(F.desc("sim"), "b")

    def lists(pairs: DataFrame, size: int) -> DataFrame:
        return (pairs.groupBy("a", "b").agg(F.max("sim").alias("sim")).withColumn("place", F.row_number().over(order))
                .where(F.col("place") <= size).select("a", "b", "sim"))

    def from_trees(pending: DataFrame, turn: int) -> DataFrame:
        leaves = pending.select("node", "label", "v", "bits").mapInArrow(
            lambda batches: planted(batches, turn), f"leaf string, along double, {NODE}")
        return staged(leaves.repartition("label", "leaf").sortWithinPartitions("label", "leaf", "along")
                      .mapInArrow(runs, "a string, b string, sim double"), "trees")

    def join_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ([], [], [])
        for _, group in _grouped(batches, ["pivot"]):
            _best([r["node"] for r in group], _unit([r["v"] for r in group]), 4, out)
            if len(out[0]) > 20_000:
                yield _pairs(*out)
                out = ([], [], [])
        if out[0]:
            yield _pairs(*out)

    def in_blocks(rows: DataFrame, group: list[str], many: str) -> DataFrame:
        """Rows of a group in blocks: the pair of blocks (i, j), i <= j, gets the rows of both."""
        blocks = F.ceil(F.col(many) / BLOCK).cast("int")
        return (rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
                .repartition(*group, "i", "j").sortWithinPartitions(*group, "i", "j"))

    def compared(asked: DataFrame) -> DataFrame:
        """(a, b): links that unite what all links within these classes unite."""
        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (*_, i, j), group in _grouped(batches, [*sets, "i", "j"]):
                rows, others = ([r for r in group if r["own"] == k] for k in (i, j))
                if not rows or not others:
                    continue
                hit = _unit([r["v"] for r in rows]) @ _unit([r["v"] for r in others]).T >= threshold
                both = [r["node"] for r in [*rows, *others]]
                pairs = [(both[x], both[y]) for x, y in zip(*_forest(hit)) if both[x] != both[y]]
                yield _rows({"a": ([x for x, _ in pairs], pa.string()), "b": ([y for _, y in pairs], pa.string())})

        here = in_blocks(sized.join(asked.select(*sets), sets, "left_semi"), sets, "n")
        return staged(here.select(*sets, "i", "j", "own", "node", "v").mapInArrow(meet, "a string, b string"), "compared")

    def missing(pending: DataFrame, links: DataFrame) -> DataFrame:
        """Classes whose planted copies lack links to their origins."""
        met = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("origin")) \
            .where(F.col("node") == F.concat(F.lit(PLANTED), F.col("origin"))).select("node").distinct() \
            .withColumn("met", F.lit(1.0))
        share = (planted_nodes.select("node", *sets).join(met, "node", "left")
                 .groupBy(*sets).agg(F.avg(F.coalesce("met", F.lit(0.0))).alias("share")))
        return staged(pending.join(share, sets).where(F.col("share") < RECALL).select(*sets), "pending")

    pending = staged(classes.where("n > 1").select(*sets), "pending")
    size, graph, links = k, None, None
    for turn in range(ROUNDS):
        if pending.isEmpty():
            break
        waiting = staged(audited.join(pending, sets, "left_semi"), "waiting")
        found = from_trees(waiting, turn)
        fresh = found.where(F.col("sim") >= threshold).select("a", "b")
        links = fresh if links is None else links.union(fresh)
        graph = found if graph is None else found.union(graph.join(waiting.select(F.col("node").alias("a")), "a", "left_semi")
                                                        .select("a", "b", "sim"))
        graph = staged(lists(graph, size), "graph")
        either = graph.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "sim") \
            .union(graph.select(F.col("b").alias("pivot"), F.col("a").alias("node"), "sim"))
        near = F.row_number().over(Window.partitionBy("pivot").orderBy(F.desc("sim"), "node"))
        members = (either.groupBy("pivot", "node").agg(F.max("sim").alias("sim")).withColumn("place", near)
                   .where(F.col("place") <= 2 * size).select("pivot", "node")
                   .union(waiting.select(F.col("node").alias("pivot"), "node")))
        met = staged(members.join(waiting.select("node", "v"), "node").repartition("pivot").sortWithinPartitions("pivot")
                     .mapInArrow(join_neighbours, "a string, b string, sim double"), "met")
        links = staged(links.union(met.where(F.col("sim") >= threshold).select("a", "b")).distinct(), "links")
        pending = missing(pending, links)
        graph = staged(lists(graph.union(met), 2 * size), "graph")
        size *= 2
    all_links = compared(pending)
    if links is not None:
        all_links = all_links.union(links.where(~F.col("a").startswith(PLANTED) & ~F.col("b").startswith(PLANTED)))
    labels = components(all_links)

    # Every node's list becomes its component, compared in blocks.
    sizes = labels.groupBy("root").agg(F.count("*").alias("size"))
    joined = staged(nodes.select("node", "v", "low", "copies").join(labels, "node"), "members")
    grid = in_blocks(joined.join(sizes, "root"), ["root"], "size")

    def count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, many = [], []
        for (_, i, j), group in _grouped(batches, ["root", "i", "j"]):
            m = _unit([r["v"] for r in group])
            own = np.array([r["own"] for r in group])
            weight = np.array([r["copies"] for r in group])
            first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
            hit = m[first] @ m[second].T >= threshold
            if i == j:
                np.fill_diagonal(hit, False)
            node += [group[x]["node"] for x in first]
            many += (hit @ weight[second]).tolist()
            if i != j:
                node += [group[x]["node"] for x in second]
                many += (weight[first] @ hit).tolist()
            if len(node) > 20_000:
                yield _rows({"node": (node, pa.string()), "links": (many, pa.int64())})
                node, many = [], []
        yield _rows({"node": (node, pa.string()), "links": (many, pa.int64())})

    counts = (grid.select("root", "i", "j", "own", "node", "v", "copies")
              .mapInArrow(count_links, "node string, links bigint")
              .groupBy("node").agg(F.sum("links").alias("links")))
    lowest = joined.groupBy("root").agg(F.min("low").alias("lowest"))
    told = staged(nodes.select("node", "low", "copies").join(joined.select("node", "root"), "node", "left")
                  .join(lowest, "root", "left").join(counts, "node", "left")
                  .select("node", F.coalesce("lowest", "low").alias("component_id"),
                          (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "told")
    known = table.where("node is not null").select("id", "node").join(told, "node").select("id", "n_links", "component_id")
    alone = table.where("node is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (known.union(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
            .withColumnRenamed("id", id_col))
