"""Operator 9: mixing sources to target weights by cube-method balanced sampling.

Every source's target (in words) is its capped share of all words.  A document
is taken ``floor(target / source_size)`` times in any case; the fractional rest
is the inclusion probability of one more copy.  The cube method moves these
probabilities along null-space directions of the balancing constraints (words
and documents taken), three undecided documents at a time, until each block has
a few undecided ones at most.  The undecided of all blocks form the next level's
blocks; a source's last few are landed on the closest totals.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from panelforge.llm.common import stage

#: Documents of one source that a task balances at once.
BLOCK = 4000
#: A document is taken at most so many times; a target is at most so many times its source's size.
REPEATS = 3
#: Undecided documents of a source that the landing decides together.
LAND = 10
#: Probabilities this close to 0 or 1 are decided.
EPS = 1e-9


def words(text: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, target) from rows (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, repeating.  Targets
    rise together with the water level ``target / weight`` and stop at
    ``REPEATS`` times the source's size.  With the sources in order of the level
    at which they stop, the level that spends everything is the largest of
    (total - stopped before) / (weights not stopped before): it rises until the
    first source that does not stop and falls after it.  One row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", (rank - 1) % 3 + 1)
    stops = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    cap = F.lit(REPEATS) * F.col("source_size")
    before = F.coalesce(F.sum(cap).over(stops.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(stops.rowsBetween(0, W.unboundedFollowing))
    everything = F.sum("source_size").over(W.partitionBy())
    level = ((everything - before) / open_weight).cast("double")
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(W.partitionBy()))
    return per.select("source", "source_size", "n_docs", F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"))


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator, leave: int = 2) -> np.ndarray:
    """Flight phase for the constraints sum(p) and sum(p * x): at most ``leave``
    (2 or more) entries of the result are neither 0 nor 1."""
    p, open_ = p.tolist(), []
    x = x.tolist()
    waiting = [i for i, v in enumerate(p) if EPS < v < 1 - EPS][::-1]
    draws = iter(())
    while len(open_) + len(waiting) > leave:
        while len(open_) < 3:
            open_.append(waiting.pop())
        a, b, c = open_
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(open_, u, strict=True) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(open_, u, strict=True) if d)
        draw = next(draws, None)
        if draw is None:
            draws = iter(rng.random(4096).tolist())
            draw = next(draws)
        step = up if draw * (up + down) < down else -down
        for i, d in zip(open_, u, strict=True):
            p[i] += step * d
        for i in list(open_):
            if p[i] <= EPS or p[i] >= 1 - EPS:
                p[i] = float(round(p[i]))
                open_.remove(i)
    return np.array([float(round(v)) if min(v, 1 - v) <= EPS else v for v in p])


def landing(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Decide the few open entries: closest total of ``x``, then of the count."""
    at = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    options = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
    off = options - p[at]
    p = p.copy()
    p[at] = options[np.lexsort((np.abs(off.sum(axis=1)), np.abs(off @ x[at])))[0]]
    return p


def _seed(*parts: object) -> int:
    return zlib.crc32(repr(parts).encode())


def balancer(level: int) -> Callable[[pa.Table], pa.Table]:
    """One block's flight, and its landing if it is all that its source has left.
    Documents are dealt with in the order of their keys; documents that share
    key and size are alike, so the outcome doesn't depend on the rows' order."""

    def balance(group: pa.Table) -> pa.Table:
        col = lambda name: group.column(name).to_numpy()
        first = {c: group.column(c)[0].as_py() for c in ("source", "block", "n_blocks")}
        order = np.lexsort((col("size"), col("k")))
        x, rng = col("size")[order].astype(np.float64), np.random.default_rng(_seed(level, first["source"], first["block"]))
        last = first["n_blocks"] == 1
        decided = flight(col("p")[order], x, rng, LAND if last else 2)
        if last:
            decided = landing(decided, x)
        p = np.empty(len(order))
        p[order] = decided
        return group.set_column(group.schema.get_field_index("p"), "p", pa.array(p))

    return balance


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken for rows
    (doc_id, source, text); other columns are not needed and not kept.

    Null texts have size 0, null sources are one source (weighed last), null
    ids and repeated rows are documents of their own.  Documents of size 0 are
    balanced as documents.  A source without words has target 0 and nothing
    taken; an empty table gives an empty result.  The draw depends only on
    doc_id, size and source, so reruns agree."""
    rows = stage(docs.select("doc_id", "source", words().alias("size")))
    plan = stage(targets(rows))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("rate", F.least(rate, F.lit(float(REPEATS))))
    plan = plan.withColumn("base", F.floor("rate")).withColumn("p", F.col("rate") - F.floor("rate"))
    plan = plan.withColumn("n_blocks", F.ceil(F.col("n_docs") / BLOCK).cast("long"))
    joined = rows.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "rate", "n_docs")
    key = F.xxhash64("doc_id", "size", F.coalesce("source", F.lit("")))
    todo = joined.withColumn("k", key).withColumn("block", F.pmod("k", F.col("n_blocks")))
    columns = ["doc_id", "source", "size", "source_size", "target", "base", "p", "n_blocks", "k", "block"]
    schema = todo.select(*columns).schema

    done, level = [], 0
    while True:
        out = stage(todo.select(*columns).groupBy("source", "block").applyInArrow(balancer(level), schema))
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(out.filter(~undecided))
        left = out.filter(undecided)
        if left.isEmpty():
            break
        sizes = left.groupBy(F.col("source").alias("_s")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("_n"))
        todo = left.drop("n_blocks").join(sizes, F.col("source").eqNullSafe(F.col("_s"))).withColumn("n_blocks", F.col("_n")).drop("_s", "_n")
        todo = todo.withColumn("block", F.pmod("block", "n_blocks"))
        level += 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    copies = F.col("base") + F.round("p").cast("long")
    return result.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
