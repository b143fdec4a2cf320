"""Operator 4: substring dedup by Rabin-Karp hashes of word windows, counted in Spark.

Every window of ``WINDOW`` words has two hashes modulo the prime 2^61 - 1.  Counting all of them would
move many times the input, and most of them occur once.  So each window first
names an anchor: the least hash among its ``GRAM``-word grams, a function of the
window's words alone.  Equal windows name equal anchors, hence a window can only
occur in two documents if its anchor does.  Anchors are counted first; windows
whose anchor was met in one document only are settled by that, all others are
counted by their own hash.  Covered words merge into maximal removal intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelforge.llm import hashing as H
from panelforge.llm.common import slices, stage, unzipped, zipped

#: Words of a window, and of the grams that anchor it.
WINDOW, GRAM = 50, 25


class Doc:
    """The windows of one document: their hashes and anchors."""

    def __init__(self, words: np.ndarray):
        self.grams = H.windows(words, GRAM, 2)
        self.anchors = H.sliding_min(self.grams, WINDOW - GRAM + 1) if len(words) >= WINDOW else np.empty(0, H.U64)


def documents(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
    """(row, bytes, word hashes of both functions) of each text of column ``text``."""
    raw, offsets = H.buffer(batch.column(batch.schema.get_field_index("text")))
    begins, ends, first = H.word_bounds(raw, offsets)
    one, two = (H.word_hashes(raw, begins, ends, w) for w in (0, 1))
    for i in range(batch.num_rows):
        lo, hi = first[i], first[i + 1]
        yield i, raw[offsets[i] : offsets[i + 1]].tobytes(), one[lo:hi], two[lo:hi]


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, digest of all words, and the document's distinct anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n, sha, anchors = [], [], []
            for _, data, one, _ in documents(part):
                n.append(len(one))
                sha.append(hashlib.sha256(b" ".join(data.split())).hexdigest())
                anchors.append(np.unique(Doc(one).anchors).view(np.int64))
            ends = np.cumsum([0, *map(len, anchors)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(anchors)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(sha), lists], names=["doc_id", "n_words", "sha", "anchors"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_words bigint, sha string, anchors array<bigint>")


def window_hashes(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc_id) of the distinct windows whose anchor is in column ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unzipped(batches):
            met = part.column(2)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i, _, one, two in documents(part):
                hot = np.isin(Doc(one).anchors, met[i].values.to_numpy().view(H.U64))
                h1, at = np.unique(H.windows(one, WINDOW, 2)[hot], return_index=True)
                h2 = H.windows(two, WINDOW, 3)[hot][at]
                out.append((h1.view(np.int64), h2.view(np.int64), np.full(len(h1), part.column(0)[i].as_py(), np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["h1", "h2", "doc_id"])

    return docs.select("doc_id", "text", "anchors").mapInArrow(run, "h1 bigint, h2 bigint, doc_id bigint")


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` places lie within ``length`` of a start: maximal intervals."""
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.subtract.at(marks, np.minimum(starts + length, n), 1)
    return np.cumsum(marks[:-1]) > 0


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, spans, kept text of rows (doc_id, text, hashes): words
    covered by a window whose first hash is in ``hashes`` go; ``spans`` holds
    begin and end of the maximal removed intervals, in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unzipped(batches):
            n, spans, kept = [], [], []
            for i, data, one, _ in documents(part):
                goes = part.column(2)[i].values.to_numpy().view(H.U64)
                gone = covered(len(one), np.flatnonzero(np.isin(H.windows(one, WINDOW, 2), goes)), WINDOW)
                edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).reshape(-1, 2)
                words = data.split()
                n.append(len(words))
                spans.append(edges.tolist())
                kept.append(b" ".join([words[j] for j in np.flatnonzero(~gone).tolist()]))
            kind = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "spans", "kept"])

    return docs.select("doc_id", "text", "hashes").mapInArrow(run, "doc_id bigint, n_words bigint, spans array<array<bigint>>, kept string")


def deduplicated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(unchanged, changed) documents of rows (doc_id, text).

    unchanged: doc_id, n_words, sha (digest of the words joined by a space);
    changed: doc_id, n_words, spans, kept (the words left, joined by a space).
    A window goes when its words also start in a document of smaller id.  Null
    and empty texts have no words; rows with a null id take no part and stay
    unchanged; rows that share an id are one document as far as ids go (none
    removes from the other).  An empty table gives empty results; further
    columns are ignored."""
    facts = stage(described(docs))
    anchors = facts.filter("doc_id is not null").select("doc_id", F.explode("anchors").alias("a"))
    met = anchors.groupBy("a").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("a")
    open_ = anchors.join(met, "a").groupBy("doc_id").agg(F.collect_set("a").alias("anchors"))
    chosen = stage(zipped(docs.select("doc_id", "text").filter("doc_id is not null")).join(open_, "doc_id"))
    hashes = window_hashes(chosen)
    first = hashes.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("h1", "h2", "lo")
    gone = stage(hashes.join(first, ["h1", "h2"]).filter("doc_id > lo").groupBy("doc_id").agg(F.collect_list("h1").alias("hashes")))
    changed = removed(chosen.select("doc_id", "text").join(gone, "doc_id"))
    return facts.join(gone.select("doc_id"), "doc_id", "left_anti").select("doc_id", "n_words", "sha"), changed


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    same, changed = deduplicated(docs)
    same = same.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))
    return same.unionByName(changed.select("doc_id", "n_words", size.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")))
