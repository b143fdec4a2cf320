"""Operator 10: near-duplicate embeddings by NN-descent.

Equal vectors are one node.  A neighbour graph starts from random projections
(nodes sorted by the signs of random hyperplanes, compared within short runs of
that order) and is refined in rounds: at each node the neighbours of its
neighbours are compared, every node keeps its ``K`` best.  Refinement goes on,
with fresh projections, until an audit against brute force finds enough of the
links of a bounded sample, node by node, as they are counted; a search that gains
nothing any more fails.  A node whose whole list passes the threshold is
saturated: components that links between saturated nodes join are united, and
its list is enlarged to all of its component, compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from panelforge.llm.common import bounds, components, runs, stage

#: Neighbours that a node keeps, and length of the compared runs.
K, RUN = 10, 128
#: Random projections to begin with and in each further attempt; signs in a code.
TABLES, SIGNS = 8, 30
#: A round that changes less than this share of all list entries is the last.
SETTLED, ROUNDS = 0.02, 4
#: Nodes of each kind in the audit, the recall it asks for, and attempts after which one without gain fails.
AUDIT, RECALL, ATTEMPTS = 400, 0.97, 4
#: Nodes of a component that are compared with as many others at once.
BLOCK = 256
#: Centres of balls that are compared with as many others at once.
CENTRES = 1024

PAIR = "u bigint, v bigint, sim double"


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of one length as unit vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def coded(nodes: DataFrame, tables: range) -> DataFrame:
    """Each node once per projection, with its sign code there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = matrix(part.column(1))
                for t in tables:
                    planes = np.random.default_rng([t, dim]).standard_normal((dim, SIGNS))
                    code = ((x @ planes) > 0) @ (1 << np.arange(SIGNS, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(x), t, np.int32)), pa.array(code)], names=["node", "vec", "dim", "tab", "code"])

    kind = nodes.schema["vec"].dataType.simpleString()
    return nodes.select("node", "vec", "dim").mapInArrow(run, f"node bigint, vec {kind}, dim int, tab int, code bigint")


def first_graph(nodes: DataFrame, tables: range) -> DataFrame:
    """The best pairs (u, v, sim) within runs of the nodes' order by sign code."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "group"):
            group = table.column("group").to_numpy()
            ids = table.column("node").to_numpy()
            for lo, hi in bounds(group):
                for at in range(lo, hi, RUN // 2):
                    end = min(at + RUN, hi)
                    if end - at > 1:
                        yield from best(ids[at:end], matrix(table.column("vec").slice(at, end - at)))
                    if end == hi:
                        break

    def best(ids: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        k = min(K // 2, len(ids) - 1)
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        rows = np.repeat(np.arange(len(ids)), k)
        cols = top.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(ids[cols]), pa.array(sims[rows, cols])], names=["u", "v", "sim"])

    keyed = coded(nodes, tables).withColumn("group", F.col("dim").cast("long") * 1_000_000 + F.col("tab"))
    ordered = keyed.repartitionByRange("group", "code", "node").sortWithinPartitions("group", "code", "node")
    return ordered.select("group", "node", "vec").mapInArrow(compare, PAIR)


def lists(pairs: DataFrame) -> DataFrame:
    """The ``K`` best of (u, v, sim, new) for each u; pairs met before are not new."""
    once = pairs.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    order = W.partitionBy("u").orderBy(F.desc("sim"), "v")
    return once.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= K).drop("_r")


def refined(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """One round: compare the neighbours (forward, and the K best backward) of each node."""
    back = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "new")
    near = lists(back).unionByName(graph).groupBy(F.col("u").alias("x"), F.col("v").alias("a")).agg(F.max("new").alias("new"))
    worst = graph.groupBy(F.col("u").alias("w")).agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("_n")).select("w", F.when(F.col("_n") >= K, F.col("worst")).otherwise(-2.0).alias("worst"))
    full = nodes.select("node", "vec").join(worst, F.col("node") == F.col("w"), "left").select("node", "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    rows = near.join(full, F.col("a") == F.col("node")).select("x", "a", "new", "vec", "worst")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "x"):
            a, worst, new = (table.column(c).to_numpy() for c in ("a", "worst", "new"))
            outs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            vecs = table.column("vec").combine_chunks()
            for lo, hi in bounds(table.column("x").to_numpy()):
                if hi - lo < 2:
                    continue
                x = matrix(vecs.slice(lo, hi - lo))
                sims = x @ x.T
                ok = (sims > worst[lo:hi, None]) & (new[lo:hi, None] | new[None, lo:hi])
                np.fill_diagonal(ok, False)
                i, j = np.nonzero(ok)
                outs.append((a[lo + i], a[lo + j], sims[i, j]))
            if outs:
                u, v, s = (np.concatenate(c) for c in zip(*outs, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s)], names=["u", "v", "sim"])

    found = rows.repartition("x").sortWithinPartitions("x").mapInArrow(local, PAIR)
    old = graph.withColumn("new", F.lit(False))
    return lists(old.unionByName(found.filter("u != v").withColumn("new", F.lit(True))))


def audit(nodes: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Mean share of a node's true links (brute force against all, in blocks) that
    ``counts`` (node, far, hot) holds: the lesser of two means, of up to ``AUDIT``
    nodes in components with saturated nodes (hot) and as many of the others.
    Nodes without a link don't count; other members of a node don't either."""
    order = (F.xxhash64("node"), "node")
    some = counts.filter("hot").orderBy(*order).limit(AUDIT).unionByName(counts.filter("not hot").orderBy(*order).limit(AUDIT))
    chosen = nodes.select("node", "vec", "dim").join(F.broadcast(some), "node").toArrow()
    ids, dims = chosen.column("node").to_numpy(), chosen.column("dim").to_numpy()
    sets = {int(d): (ids[dims == d], matrix(chosen.filter(pa.array(dims == d)).column("vec"))) for d in np.unique(dims)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = batch.column(2).to_numpy()
            for dim, (qid, q) in sets.items():
                part = batch.filter(pa.array(here == dim))
                if part.num_rows:
                    near = matrix(part.column(1)) @ q.T >= threshold
                    near &= part.column(0).to_numpy()[:, None] != qid[None, :]
                    n = part.column(3).to_numpy() @ near
                    yield pa.RecordBatch.from_arrays([pa.array(qid[n > 0]), pa.array(n[n > 0])], names=["node", "n"])

    true = nodes.select("node", "vec", "dim", "members").mapInArrow(run, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n"))
    shares = true.join(F.broadcast(some), "node").groupBy("hot").agg(F.avg(F.least(F.col("far") / F.col("n"), F.lit(1.0))).alias("share")).collect()
    return min((r["share"] for r in shares), default=1.0)


def balls(ids: np.ndarray, x: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """The rows of ``x`` in balls: rows, centre and angle from it to the farthest row."""
    left = np.arange(len(ids))
    while len(left):
        near = x[left] @ x[left[0]] >= cosine
        near[0] = True
        rows, left = left[near], left[~near]
        centre = x[rows].sum(axis=0)
        centre = centre / np.linalg.norm(centre)
        yield rows, centre, float(np.arccos(np.clip(x[rows] @ centre, -1, 1)).max())


def joined(nodes: DataFrame, roots: DataFrame, saturated: DataFrame, threshold: float) -> DataFrame:
    """``roots`` with components united that a link between saturated nodes joins.

    A full list may hold none of a node's links to another component, so these
    are searched without lists.  Each component's saturated nodes lie in balls;
    two balls are compared row by row unless their centres are farther apart
    than a link and both radii.  A node that is not saturated has room for all
    its links."""
    limit = float(np.arccos(threshold)) + 1e-6
    rows = roots.join(saturated.select("node"), "node", "left_semi").join(nodes.select("node", "vec", "dim"), "node")
    sizes = rows.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    rows = rows.join(sizes, "root").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))

    def cover(cell: pa.Table) -> pa.Table:
        ids = cell.column("node").to_numpy()
        found = list(balls(ids, matrix(cell.column("vec")), threshold))
        return pa.table(
            {
                "ball": pa.array([ids[r].min() for r, _, _ in found], pa.int64()),
                "root": cell.column("root").slice(0, len(found)),
                "dim": cell.column("dim").slice(0, len(found)),
                "centre": pa.array([c.tolist() for _, c, _ in found], pa.list_(pa.float64())),
                "radius": pa.array([a for _, _, a in found], pa.float64()),
                "rows": pa.array([ids[r].tolist() for r, _, _ in found], pa.list_(pa.int64())),
            }
        )

    cells = rows.select("root", "part", "dim", "node", "vec").repartition("root", "part").groupBy("root", "part")
    covers = stage(cells.applyInArrow(cover, "ball bigint, root bigint, dim int, centre array<double>, radius double, rows array<bigint>"))
    if covers.select("root").distinct().limit(2).count() < 2:
        return roots
    many = covers.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / CENTRES).cast("int").alias("parts"))
    dealt = covers.drop("rows").join(F.broadcast(many), "dim").withColumn("mine", F.pmod(F.xxhash64("ball"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("dim", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "ball", "root", "centre", "radius")

    def close(cell: pa.Table) -> pa.Table:
        ball, root, radius = (cell.column(c).to_numpy() for c in ("ball", "root", "radius"))
        x = matrix(cell.column("centre"))
        angle = np.arccos(np.clip(x @ x.T, -1, 1))
        i, j = np.nonzero((angle <= limit + radius[:, None] + radius[None, :]) & (root[:, None] < root[None, :]))
        return pa.table({"a": ball[i], "b": ball[j], "ra": root[i], "rb": root[j]})

    near = dealt.groupBy("dim", "i", "j").applyInArrow(close, "a bigint, b bigint, ra bigint, rb bigint").distinct()
    near = stage(near.withColumn("cell", F.monotonically_increasing_id()))
    sides = near.select("cell", F.lit(0).alias("side"), F.col("a").alias("ball")).unionByName(near.select("cell", F.lit(1).alias("side"), F.col("b").alias("ball")))
    held = sides.join(covers.select("ball", "root", F.explode("rows").alias("node")), "ball").join(nodes.select("node", "vec"), "node")

    def meet(cell: pa.Table) -> pa.Table:
        side, root = cell.column("side").to_numpy(), cell.column("root").to_numpy()
        x = matrix(cell.column("vec"))
        linked = bool((x[side == 0] @ x[side == 1].T >= threshold).any())
        return pa.table({"a": root[side == 0][:linked], "b": root[side == 1][:linked]})

    met = held.select("cell", "side", "root", "vec").groupBy("cell").applyInArrow(meet, "a bigint, b bigint").distinct()
    new = components(met).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return stage(roots.join(new, "root", "left").select("node", F.coalesce("top", "root").alias("root")))


def enlarged(nodes: DataFrame, roots: DataFrame, saturated: DataFrame, threshold: float) -> DataFrame:
    """(node, n_links) of saturated nodes, from their whole components in blocks."""
    hot = roots.join(saturated.select("node"), "node", "left_semi")
    whole = roots.join(hot.select("root").distinct(), "root", "left_semi").join(nodes, "node")
    rows = stage(whole.join(saturated.select("node", F.lit(True).alias("sat")), "node", "left").select("node", "root", "vec", "members", F.coalesce("sat", F.lit(False)).alias("sat")))
    sizes = rows.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(sizes, "root").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    asks = rows.filter("sat").select("root", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "node", "vec", "members", F.lit(True).alias("asks"))
    gives = rows.select("root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("mine"), F.col("mine").alias("other"), "node", "vec", "members", F.lit(False).alias("asks"))

    def near_members(cell: pa.Table) -> pa.Table:
        asks = cell.column("asks").to_numpy(zero_copy_only=False)
        q, t = cell.filter(pa.array(asks)), cell.filter(pa.array(~asks))
        n = np.zeros(q.num_rows, np.int64)
        if q.num_rows and t.num_rows:
            near = matrix(q.column("vec")) @ matrix(t.column("vec")).T >= threshold
            near &= q.column("node").to_numpy()[:, None] != t.column("node").to_numpy()[None, :]
            n = near @ t.column("members").to_numpy()
        return pa.table({"node": q.column("node"), "n": pa.array(n)})

    cells = asks.unionByName(gives).groupBy("root", "mine", "other").applyInArrow(near_members, "node bigint, n bigint")
    return cells.groupBy("node").agg(F.sum("n").alias("far"))


def linked(vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for rows (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without an id, link with nothing (component_id is the own id; kept
    is false without one).  Vectors of different lengths don't link.  Equal
    vectors, repeated rows among them, link with each other.  An empty table
    gives an empty result; further columns are ignored."""
    v = F.col("vec")
    good = F.col("vec_id").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec).alias("vec")).withColumn("good", F.coalesce(good, F.lit(False)))
    rows = rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(7), "vec")})
    classes = rows.filter("good").groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("members"), F.first("vec").alias("vec"))
    nodes = stage(classes.withColumns({"dim": F.size("vec"), "node": F.monotonically_increasing_id()}))
    n = nodes.count()

    size = nodes.select("node", "members")
    graph, best = None, 0.0
    for attempt in count():
        start = first_graph(nodes, range(attempt * TABLES, (attempt + 1) * TABLES)).withColumn("new", F.lit(True))
        graph = stage(lists(start if graph is None else start.unionByName(graph.withColumn("new", F.lit(False)))))
        for _ in range(ROUNDS):
            graph = stage(refined(graph, nodes))
            if graph.filter("new").count() <= SETTLED * n * K:
                break
        near = graph.filter(F.col("sim") >= threshold)
        per = near.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("_n"))
        saturated = stage(per.filter(F.col("_n") >= K))
        roots = joined(nodes, components(near.select(F.col("u").alias("a"), F.col("v").alias("b"))), saturated, threshold)
        links = near.select("u", "v").unionByName(near.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
        plain = links.join(size, F.col("v") == F.col("node")).groupBy(F.col("u").alias("node")).agg(F.sum("members").alias("close"))
        hot = roots.join(saturated.select("node"), "node", "left_semi").select("root", F.lit(True).alias("hot")).distinct()
        linked_to = nodes.select("node").join(plain, "node", "left").join(enlarged(nodes, roots, saturated, threshold), "node", "left").join(roots, "node", "left").join(hot, "root", "left")
        linked_to = stage(linked_to.select("node", "root", F.coalesce("far", "close", F.lit(0)).cast("long").alias("far"), F.coalesce("hot", F.lit(False)).alias("hot")))
        recall = audit(nodes, linked_to.select("node", "far", "hot"), threshold)
        if recall >= RECALL:
            break
        if attempt + 1 >= ATTEMPTS and recall <= best:
            raise RuntimeError(f"{attempt + 1} attempts found {recall:.3f} of the audited links, less than {RECALL}")
        best = max(best, recall)

    counts = nodes.select("node", "h1", "h2", "least", "members").join(linked_to, "node")
    counts = counts.select("h1", "h2", "least", F.coalesce("root", "node").alias("root"), (F.col("members") - 1 + F.col("far")).alias("n_links"))
    counts = stage(counts)
    lowest = counts.groupBy("root").agg(F.min("least").alias("component_id"))
    counts = counts.join(lowest, "root").select("h1", "h2", "n_links", "component_id", F.lit(True).alias("good"))
    out = rows.select("vec_id", "h1", "h2", "good").join(counts, ["h1", "h2", "good"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
