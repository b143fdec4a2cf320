"""Operator 11: ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items form one automaton, each guarded by a term boundary on
both sides, so that one pass over a text finds every whole term with its count
and no other; no index of the documents is built.  A first scan gathers the
corpus figures (documents, terms, and the documents that hold each item term), a
second one scores: the automaton's outputs map to the items that hold a term,
and a task keeps the best documents of each item.

Items come in batches of bounded size, each with an automaton of its own.

Nulls and empty texts have no terms; a document or item without terms is in no
result.  Rows of documents are documents of their own, whatever their ids; ids
that are null come after all others of equal score.  Items that share an id are
one item with the terms of their distinct texts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelforge.llm.common import slices, stage

#: Bytes of terms and items that one automaton holds at most (one item at least).
TERM_BYTES, ITEMS = 1_000_000, 4096
#: Documents that each item gets.
TOP = 10
#: Final lists are made from this many parts.
PARTS = 32
#: Weight of a document's length, in hundredths.
LENGTH = 75

GUARD = "\n"
_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
#: Every separator becomes the guard, A-Z their small letters.
FOLD = {**{c: GUARD for c in _SEPARATORS}, **{c: chr(c + 32) for c in range(0x41, 0x5B)}}
_INSIDE = np.ones(256, bool)
_INSIDE[_SEPARATORS] = False


class Batch(NamedTuple):
    """Items of one automaton: terms, and per term the items with repeats."""

    items: list[int | None]
    terms: list[str]
    begin: np.ndarray  # of a term's items, n + 1
    item: np.ndarray
    times: np.ndarray


def folded(text: str) -> str:
    return GUARD + text.translate(FOLD) + GUARD


def automaton(terms: list[str]) -> ahocorasick.Automaton | None:
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(GUARD + term + GUARD, number)
    found.make_automaton()
    return found if terms else None


def batches(items: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    """Items dealt by the hash of their id so that a batch has about half of TERM_BYTES."""
    rows = items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text")).filter("text is not null").distinct()
    rows = stage(rows)
    size, n = rows.agg(F.sum(F.octet_length("text")), F.countDistinct(F.coalesce("item", F.lit(-1)))).first()
    parts = max(1, math.ceil(2 * (size or 0) / TERM_BYTES), math.ceil(2 * n / ITEMS))
    part = F.pmod(F.xxhash64("item"), F.lit(parts))
    return [rows.filter(part == k) for k in range(parts)]


def gathered(rows: DataFrame) -> Batch:
    """One batch on the driver; its size is bounded by ``batches``."""
    count: dict[tuple[str, int | None], int] = Counter()
    for item, text in rows.toLocalIterator():
        for term in folded(text).split(GUARD):
            if term:
                count[term, item] += 1
    items = sorted({i for _, i in count}, key=lambda i: (i is None, i or 0))
    place = {i: k for k, i in enumerate(items)}
    terms = sorted({t for t, _ in count})
    number = {t: k for k, t in enumerate(terms)}
    cells = sorted((number[t], place[i], n) for (t, i), n in count.items())
    of, item, times = np.array(cells, np.int64).reshape(-1, 3).T
    return Batch(items, terms, np.searchsorted(of, np.arange(len(terms) + 1)), item, times)


def _counted(found: ahocorasick.Automaton | None, texts: list[str | None]) -> Iterator[tuple[int, Counter]]:
    """A text's number of terms, and the counts of those that the automaton holds."""
    for text in texts:
        if not text:
            yield 0, Counter()
            continue
        text = folded(text)
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        inside = _INSIDE[raw]
        yield int(np.count_nonzero(inside[1:] & ~inside[:-1])), Counter(k for _, k in found.iter(text)) if found else Counter()


def corpus(docs: DataFrame, batch: Batch) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and each batch term's documents."""
    shared = docs.sparkSession.sparkContext.broadcast(batch.terms)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(shared.value)
        holding, n_docs, n_terms = np.zeros(len(shared.value), np.int64), 0, 0
        for part in slices(parts, "text"):
            for n, counts in _counted(found, part.column(0).to_pylist()):
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                holding[list(counts)] += 1
        some = np.flatnonzero(holding)
        keys = np.concatenate([some, [-1, -2]])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([holding[some], [n_docs, n_terms]]))], ["k", "n"])

    rows = dict(docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n")).collect())
    return rows.get(-1, 0), rows.get(-2, 0), np.array([rows.get(k, 0) for k in range(len(batch.terms))], np.int64)


def weights(n_docs: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in holding], np.int64)


class Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int):
        self.top, self.bar = top, np.ones(items, np.int64)
        self.rows = [np.empty(0, np.int64) for _ in range(4)]  # item, score, no id, id
        self.waiting: list[list[np.ndarray]] = []
        self.n = 0

    def add(self, item: np.ndarray, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.bar[item]
        self.waiting.append([x[good] for x in (item, score, no_id, ids)])
        self.n += int(good.sum())
        if self.n > 4 * self.top * len(self.bar) + 10_000:
            self.settle()

    def settle(self) -> None:
        item, score, no_id, ids = (np.concatenate(x) for x in zip(self.rows, *self.waiting, strict=True))
        order = np.lexsort((ids, no_id, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[place < self.top]
        last = order[place == self.top - 1]
        self.rows = [item[place < self.top], score[keep], no_id[keep], ids[keep]]
        self.bar[item[place == self.top - 1]] = score[last]
        self.waiting, self.n = [], 0


def scored(docs: DataFrame, batch: Batch, n_docs: int, n_terms: int, holding: np.ndarray, top: int) -> DataFrame:
    """(item, doc_id, score): every task's best documents of each item of the batch."""
    shared = docs.sparkSession.sparkContext.broadcast((batch, weights(n_docs, holding)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, weight = shared.value
        found, best, lengths = automaton(b.terms), Best(len(b.items), top), np.diff(b.begin)
        for part in slices(parts, "text"):
            ids = part.column(0)
            no_id = np.asarray(ids.is_null()).astype(np.int64)
            ids = np.asarray(ids.fill_null(0)).astype(np.int64)
            doc, term, tf, m = [], [], [], []
            for row, (n, counts) in enumerate(_counted(found, part.column(1).to_pylist())):
                doc += [row] * len(counts)
                term += counts.keys()
                tf += counts.values()
                m += [100 - LENGTH + LENGTH * n * n_docs // max(n_terms, 1)] * len(counts)
            if not doc:
                continue
            doc, term, tf, m = (np.array(x, np.int64) for x in (doc, term, tf, m))
            gain = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            # one cell for each document, term and item that holds the term
            n = lengths[term]
            at = np.repeat(b.begin[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
            total = np.zeros(part.num_rows * len(b.items), np.int64)
            np.add.at(total, np.repeat(doc, n) * len(b.items) + b.item[at], np.repeat(gain, n) * b.times[at])
            cell = np.flatnonzero(total)
            row = cell // len(b.items)
            best.add(cell % len(b.items), total[cell], no_id[row], ids[row])
        best.settle()
        item, score, no_id, ids = best.rows
        names = pa.array(b.items, pa.int64()).take(pa.array(item))
        yield pa.RecordBatch.from_arrays([names, pa.array(ids, mask=no_id > 0), pa.array(score)], ["item_id", "doc_id", "score"])

    return docs.select("id", "text").mapInArrow(run, "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``top`` best documents."""
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    found = []
    for rows in batches(items, item_id, text):
        batch = gathered(rows)
        if batch.terms:
            found.append(stage(scored(docs, batch, *corpus(docs, batch), top)))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    first = every.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order)))
    first = first.filter(F.col("rank") <= top).drop("rank", "part")
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return last.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
