"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelforge.session import reliable_checkpoint

#: A word is a run of bytes other than space and tab to carriage return.
WORD_BREAKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage: a parquet table in the session's shared folder, read back."""
    return reliable_checkpoint(df)


def _parts(batch: pa.RecordBatch, sizes: list[int], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows in slices of about ``limit`` by their sizes, one row at least."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Rows regrouped into slices of about ``limit`` bytes of ``column``, so that a
    task's working memory follows the longest text and not the Arrow batch size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()
        yield from _parts(batch, sizes, limit)


def zipped(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with column ``text`` compressed, for joins that move whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches, text):
            at = part.schema.get_field_index(text)
            data = [None if t is None else zip_(t) for t in part.column(at).cast(pa.binary()).to_pylist()]
            yield part.set_column(at, text, pa.array(data, pa.binary()))

    schema = ", ".join(f"`{f.name}` {'binary' if f.name == text else f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, schema)


def unzipped(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Slices, by the texts' own sizes, with the texts of ``zipped`` as bytes."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        sizes = [0 if z is None else zstandard.frame_content_size(z) for z in batch.column(at).to_pylist()]
        for part in _parts(batch, sizes, limit):
            unzip = zstandard.ZstdDecompressor().decompress
            data = [b"" if z is None else unzip(z) for z in part.column(at).to_pylist()]
            yield part.set_column(at, text, pa.array(data, pa.large_binary()))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches in which equal keys are neighbours."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held:
            last = held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py()
            if keys[0] != last:
                yield pa.Table.from_batches(held)
                held = []
        if held and not len(change):
            held.append(batch)
            continue
        cut = int(change[-1]) if len(change) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def bounds(keys: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return list(zip([0, *change.tolist()], [*change.tolist(), len(keys)], strict=True)) if len(keys) else []


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over ``links`` (a, b), for every
    node that has a link.

    Each round hooks every label to its least neighbour, if that is smaller (a
    partial aggregate, so a node with many links is no hot spot), follows the
    hooks to their ends, which halves what is left of them each time, and puts
    the ends in place of the links' own.  Two rounds leave at most half of the
    labels that still have links, whatever the diameter; it ends when no link is
    left.  Every step is a written table, so a lost executor costs one at most."""
    pairs = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(pairs.distinct())
    roots = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        ends = edges.groupBy("a").agg(F.min("b").alias("root")).withColumn("moved", F.lit(True))
        while True:
            ends = stage(ends)
            if ends.filter("moved").isEmpty():
                break
            top = ends.select(F.col("a").alias("root"), F.col("root").alias("top"))
            ends = ends.join(top, "root", "left").select("a", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved"))
        end = lambda c: ends.select(F.col("a").alias(c), F.col("root").alias(f"_{c}"))
        roots = stage(roots.join(end("root"), "root", "left").select("node", F.coalesce("_root", "root").alias("root")))
        a, b = F.coalesce("_a", "a"), F.coalesce("_b", "b")
        moved = edges.join(end("a"), "a", "left").join(end("b"), "b", "left").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        edges = stage(moved.filter("a != b").distinct())
    return roots
