"""Operator 3: toxicity by Levenshtein automata over a lexicon trie, with context.

A lexicon of terms (words, and open stems that many words share) is learned from
labelled documents.  Each word of a text runs through the intersection of the
terms' Levenshtein automata with the trie of the terms, kept as a lazily built
deterministic automaton: most words leave it after a few letters.  Every hit is
weighed by its surroundings: quotation marks around it, and the words of a
window on both sides with learned weights, tell quotation from abuse.  A
logistic regression turns the hits of a document into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelforge.llm.common import slices, stage

#: Labelled rows that the model is fitted on, at most (those of least hash), and the bytes
#: of their texts together (whole texts of least hash, as many as fit).  A term needs SUPPORT documents of these, which bounds the lexicon.
SAMPLE, SAMPLE_BYTES = 20_000, 128_000_000
#: Lengths of stems; other lengths are whole words only.
STEMS = range(4, 9)
#: Toxic documents, and different words before it there, that a term needs; share of toxic documents among its own.
SUPPORT, SURROUNDINGS, PRECISION = 8, 6, 0.8
#: A stem goes on to a longer one that holds this share of its documents.
SAME = 0.95
#: Different words from which a stem is open; letters from which one edit is allowed.
FAMILY, FUZZY = 3, 5
#: What a misspelled hit counts of its term's weight.
PART = 0.7
#: Words on each side of a hit that are its context.
WINDOW = 8
#: States and words that a worker remembers.
STATES, MEMO = 200_000, 1_000_000

WORD = re.compile(r"[^\W\d_]+")
#: Marks that open a quotation, with those that close it; it ends with its line.
CLOSING = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«"}
MARK, CITED = re.compile(r'["“”„«»\n]'), re.compile(r"[^\S\n]*>")
FEATURES = 7


class Term(NamedTuple):
    text: str
    open: bool
    weight: float


class Automaton:
    """The lexicon's trie intersected with one-edit Levenshtein automata.

    A state is a set of (trie node, edits so far); an edit may fall on the first
    letter only where ``any_first`` says so, as the operator does.  Reading a word
    gives its best term and the edits, or None."""

    def __init__(self, terms: list[Term], any_first: bool = False):
        self.terms, self.any_first = terms, any_first
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}
        self.reach = [False]  # does a term of FUZZY letters or more lie below?
        for number, term in enumerate(terms):
            node = 0
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.reach.append(False)
                node = self.children[node][c]
                self.reach[node] |= len(term.text) >= FUZZY
            self.reach[0] |= len(term.text) >= FUZZY
            self.ends[node] = number
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[frozenset[tuple[int, int]], int] = {}
        self.sets: list[frozenset[tuple[int, int]]] = []
        self.steps: list[dict[str, int]] = []
        self.stops: list[tuple[int, int] | None] = []  # an open stem is reached
        self.known: dict[str, tuple[int, int] | None] = {}
        self.start = self.number(frozenset([(0, 0)]))

    def number(self, states: frozenset[tuple[int, int]]) -> int:
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.steps.append({})
            self.stops.append(self.accepted(states, True))
        return self.numbers[states]

    def accepted(self, states: frozenset[tuple[int, int]], open_only: bool) -> tuple[int, int] | None:
        found = []
        for node, edits in states:
            number = self.ends.get(node)
            if number is not None and (self.terms[number].open or not open_only) and (not edits or len(self.terms[number].text) >= FUZZY):
                found.append((edits, -self.terms[number].weight, number))
        return (min(found)[2], min(found)[0]) if found else None

    def step(self, states: frozenset[tuple[int, int]], c: str) -> frozenset[tuple[int, int]]:
        best: dict[int, int] = {}

        def put(node: int, edits: int) -> None:
            if best.get(node, 2) > edits:
                best[node] = edits

        for node, edits in states:
            children = self.children[node]
            if c in children:
                put(children[c], edits)
            if (node or self.any_first) and not edits:
                if self.reach[node]:
                    put(node, 1)  # a letter too many
                for letter, child in children.items():
                    if self.reach[child]:
                        put(child, 1)  # another letter
                        if c in (below := self.children[child]) and letter != c:
                            put(below[c], 1)  # a letter missing
        return frozenset(best.items())

    def read(self, word: str) -> tuple[int, int] | None:
        state, best = self.start, None
        for c in word:
            following = self.steps[state].get(c)
            if following is None:
                following = self.steps[state][c] = self.number(self.step(self.sets[state], c))
            state, stop = following, self.stops[following]
            if stop is not None:
                if not stop[1]:
                    return stop
                best = best or stop
            if not self.sets[state]:
                return best
        missing = {(child, 1) for node, edits in self.sets[state] if (node or self.any_first) and not edits for child in self.children[node].values()}
        last = self.accepted(self.sets[state] | missing, False)
        return last if last is not None and (best is None or last[1] < best[1]) else best

    def find(self, word: str) -> tuple[int, int] | None:
        try:
            return self.known[word]
        except KeyError:
            if len(self.known) >= MEMO or len(self.sets) >= STATES:
                self.clear()
            self.known[word] = found = self.read(word)
            return found


class Hit(NamedTuple):
    term: Term
    edits: int
    quoted: bool
    context: list[str]


class Model(NamedTuple):
    terms: list[Term]
    cues: dict[str, float]
    weights: np.ndarray


def in_quotes(text: str, places: list[int]) -> list[bool]:
    """Whether each of the rising ``places`` is in a quotation or in a line that
    begins with '>', from one pass over the text's marks."""
    out: list[bool] = []
    cited, opened = CITED.match(text) is not None, ""
    marks = MARK.finditer(text)
    mark = next(marks, None)
    for place in places:
        while mark is not None and mark.start() < place:
            c = mark.group()
            if c == "\n":
                cited, opened = CITED.match(text, mark.end()) is not None, ""
            elif not opened:
                opened = c if c in CLOSING else ""
            elif c in CLOSING[opened]:
                opened = ""
            mark = next(marks, None)
        out.append(cited or bool(opened))
    return out


def hits(text: str, automaton: Automaton) -> list[Hit]:
    lower = text.lower()
    words = WORD.findall(lower)
    known, find = automaton.known, automaton.find
    at = [i for i, w in enumerate(words) if (known[w] if w in known else find(w)) is not None]
    if not at:
        return []
    places = [m.start() for m in WORD.finditer(lower)]
    quoted = in_quotes(lower, [places[i] for i in at])
    out = []
    for i, inside in zip(at, quoted, strict=True):
        number, edits = automaton.find(words[i])
        out.append(Hit(automaton.terms[number], edits, inside, words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]))
    return out


def features(found: list[Hit], cues: dict[str, float]) -> list[float]:
    """Bias; weights of hits, bare and quoted (misspelled ones in part); weights of
    misspelled hits alone, bare and quoted; the contexts' mean; any hit.  Where
    misspellings were rare among the labelled rows, they so count like hits."""
    sums = [0.0] * 4
    contexts = []
    for hit in found:
        sums[hit.quoted] += hit.term.weight * (PART if hit.edits else 1.0)
        sums[2 + hit.quoted] += hit.term.weight * bool(hit.edits)
        contexts.append(sum(cues.get(w, 0.0) for w in set(hit.context)))
    context = max(-5.0, min(5.0, sum(contexts) / len(contexts))) if contexts else 0.0
    return [1.0, *(math.log1p(s) for s in sums), context, float(bool(found))]


def _counted(train: DataFrame) -> DataFrame:
    """(key, stem, toxic, clean): documents by word and by stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            out = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())]
            counts[0].clear()
            counts[1].clear()
            return pa.RecordBatch.from_arrays(out, names=["key", "stem", "toxic", "clean"])

        for part in slices(batches, "text"):
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                words = set(WORD.findall((text or "").lower()))
                counts[toxic].update((w, False) for w in words)
                counts[toxic].update({(w[:n], True) for w in words for n in STEMS if len(w) >= n})
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield flush()
        yield flush()

    parts = train.select("text", "toxic").mapInArrow(run, "key string, stem boolean, toxic bigint, clean bigint")
    return parts.groupBy("key", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _surroundings(train: DataFrame, keys: set[tuple[str, bool]]) -> DataFrame:
    """(key, stem, before, words): different words before a key, and of a stem, in toxic documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = set()
            for text in part.column(0).to_pylist():
                words = WORD.findall((text or "").lower())
                for before, w in zip(["", *words], words, strict=False):
                    for key in ((w, False), *((w[:n], True) for n in STEMS if len(w) >= n)):
                        if key in keys:
                            found.add((*key, before, w))
            columns = list(zip(*found, strict=True)) if found else [()] * 4
            kinds = [pa.string(), pa.bool_(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "stem", "before", "word"])

    rows = train.filter("toxic = 1").select("text").mapInArrow(run, "key string, stem boolean, before string, word string")
    return rows.groupBy("key", "stem").agg(F.count_distinct("before").alias("before"), F.count_distinct("word").alias("words"))


def lexicon(train: DataFrame) -> list[Term]:
    """Terms learned from rows (text, toxic), best first.  Words that only follow
    one and the same word (copies of one document) are no terms."""
    docs = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    rows = _counted(train).filter((F.col("toxic") >= SUPPORT) & (share >= PRECISION))
    found = {(r["key"], r["stem"]): (r["toxic"], r["clean"]) for r in rows.collect()}  # at most 1 / SUPPORT of the words and stems in SAMPLE_BYTES
    around = {(r["key"], r["stem"]): (r["before"], r["words"]) for r in _surroundings(train, set(found)).collect()}
    known = {k: v for k, v in found.items() if around.get(k, (0, 0))[0] >= SURROUNDINGS}

    def weight(key: tuple[str, bool]) -> float:
        toxic, clean = known[key]
        return math.log((toxic + 0.5) / (docs.get(1, 0) + 1)) - math.log((clean + 0.5) / (docs.get(0, 0) + 1))

    terms: dict[str, Term] = {}
    taken: list[str] = []
    stems = sorted((k for k in known if k[1] and around[k][1] >= FAMILY), key=lambda k: (len(k[0]), k[0]))
    longer = {k[0][:-1]: k for k in sorted(stems, key=lambda k: (known[k][0], k[0]))}  # the most frequent continuation
    for key in stems:
        if not key[0].startswith(tuple(taken)):
            while (more := longer.get(key[0])) and known[more][0] >= SAME * known[key][0]:
                key = more
            taken.append(key[0])
            terms[key[0]] = Term(key[0], True, weight(key))
    for key in (k for k in known if not k[1]):
        if not key[0].startswith(tuple(taken)):
            terms[key[0]] = Term(key[0], False, weight(key))
    return sorted(terms.values(), key=lambda t: (-t.weight, t.text))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the bias is not shrunk."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-9, *[ridge] * (x.shape[1] - 1)]) * max(1, len(y)) / 100
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty @ w
        hess = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + penalty
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def learned(train: DataFrame) -> Model:
    """The model of rows (text, toxic 0 or 1), as ``sampled`` gives them."""
    terms = lexicon(train)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms, any_first=True)
        for part in slices(batches, "text"):
            words: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for w in {w for hit in hits(text or "", automaton) for w in hit.context}:
                    words[w][toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([v[1] for v in words.values()], pa.int64()), pa.array([v[0] for v in words.values()], pa.int64())], names=["word", "toxic", "clean"])

    some = train.select("text", "toxic").mapInArrow(contexts, "word string, toxic bigint, clean bigint").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rows = some.filter(F.col("clean") >= SUPPORT).orderBy(F.desc("clean"), "word").collect()
    total = [max(1, sum(r[c] for r in rows)) for c in ("toxic", "clean")]
    cues = {r["word"]: math.log((r["toxic"] + 1) / (total[0] + 1)) - math.log((r["clean"] + 1) / (total[1] + 1)) for r in rows}

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms, any_first=True)
        for part in slices(batches, "text"):
            x = [features(hits(t or "", automaton), cues) for t in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), part.column(1)], names=["x", "toxic"])

    rows = train.select("text", "toxic").mapInArrow(measured, "x array<double>, toxic int").toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, FEATURES)
    y = rows.column("toxic").to_numpy().astype(float)
    order = np.lexsort((y, *x.T))  # the fit doesn't depend on the rows' order
    return Model(terms, cues, fit(x[order], y[order]) if len(y) else np.zeros(FEATURES))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and terms (those found, as matched) of rows (doc_id, text)."""
    terms, cues, weights = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms, any_first=True)
        for part in slices(batches, "text"):
            found = [hits(t or "", automaton) for t in part.column(1).to_pylist()]
            x = np.array([features(f, cues) for f in found])
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            names = [sorted({h.term.text for h in f}) for f in found]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array(names, pa.list_(pa.string()))], names=["doc_id", "score", "terms"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double, terms array<string>")


def sampled(docs: DataFrame, usable: DataFrame) -> DataFrame:
    """(text, toxic) of at most ``SAMPLE`` rows and ``SAMPLE_BYTES`` of labelled texts."""
    ids = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = stage(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"))  # SAMPLE rows of two numbers
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sizes = rows.groupBy("doc_id").agg(F.sum(size).alias("_bytes")).filter(F.col("_bytes") <= SAMPLE_BYTES)  # a row each
    so_far = F.sum("_bytes").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = sizes.withColumn("_so_far", so_far).filter(F.col("_so_far") <= SAMPLE_BYTES).select("doc_id")
    return rows.join(fits, "doc_id", "left_semi").select("text", "toxic")


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, terms of rows (doc_id, text), learned
    from labels (doc_id, toxic) that are not held out.

    Null and empty texts have no hits and take the score of such documents; a
    null id is not held out and not learned from; labels other than 0 and 1,
    contradicting ones of one id too, are not learned from.  Without labels all
    scores are 0.5.  Repeated rows get equal scores, an empty table an empty
    result; further columns are ignored."""
    usable = labels.filter(~held_out()).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_m")).filter("toxic = _m and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    out = scored(docs, learned(stage(sampled(docs, usable))))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "terms")
