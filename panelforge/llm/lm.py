"""Operator 13: language-model scoring by a probabilistic suffix tree over words.

Counts are gathered from all training documents in Spark, and the tree is a table:

* A word, a pair or a triple of words is *frequent* when it occurs at least
  ``max(SUPPORT, LEAST x training tokens)`` times; no share is asked for (LEAST 0), so
  the tree grows with the corpus.
* Contexts are frequent words and pairs.  A context is a state of the tree when its
  next symbols diverge from those of its longest suffix that is one: the gain in
  log-likelihood over the training occurrences must exceed the cost of its symbols.
* A state gives a frequent next word its discounted share; what is left goes to all
  other words as the next shorter state has them.  The root is the add-one unigram
  distribution over all training words and one unknown.  Every state's distribution
  over all words, the end of a text and the unknown sums to one.
* A text is scored by the longest suffix state before each token.

Words that make a share of NUMBERED have numbers by a broadcast table, the others are
known by 62 bits of their hashes.  What has that share is broadcast too, in the end.  A text's score is its unigram score and the sum of
what its words, pairs and triples add as the tree has them.  Texts lie in slices; a
slice sends its distinct words, pairs and triples, packed, to buckets that add them up
over all slices, and gets back what those of them add that are in the tree.  Pairs of
words, and triples of pairs, that a bit table of bounded size shows to be infrequent
are not sent; what it lets through in excess the count removes.

Texts are read for the words' counts, and to turn every text into numbers (staged) and
a list of its words without one, whose counts a join adds.

Null and empty texts have one token, their end.  Rows are texts of their own,
repeated ones too; rows without an id train the model.  Without training rows every
word is unknown.  Further columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm import hashing as H
from panelforge.llm.common import slices, stage

#: Least occurrences, and least share of the training tokens, of what is frequent.
SUPPORT, LEAST = 8, 0.0
#: Least share of the training tokens of a word with a number of its own: 1 / NUMBERED at most.
NUMBERED = 2.0**-20
#: Taken off every count of a next symbol; nats that a state must gain for each of its symbols.
DISCOUNT, COST = 0.75, 6.0
#: Bytes of text that are counted at once, tokens of a slice, and of a bucket.
SLICE, TOKENS, BUCKET = 4_000_000, 500_000, 1_000_000
#: Places in slices that are packed at once.
SENT = 300_000
#: Binary digits of a place in the bit tables of frequent words and pairs, and in one piece of them.
BITS, PIECE = 25, 20
FOLDS, HELD_OUT = 7, 2

END = 1  # the number of a text's end; 0 are words that are not frequent
HASHED = 1 << 62  # from here on hashes are the words' numbers


def remainder(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z lowered, and each text's first word (n + 1)."""
    raw, offsets = H.buffer(texts)
    begins, ends, first = H.word_bounds(raw, offsets)
    lengths = np.concatenate(([0], np.cumsum(ends - begins)))
    data = H.LOWER[raw[~H.BREAK[raw]]]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(data)]), first


def counted(docs: DataFrame) -> DataFrame:
    """(word, c): occurrences of every word of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            found = words(part.column(0))[0].dictionary_encode()
            n = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
            yield pa.RecordBatch.from_arrays([found.dictionary.cast(pa.binary()), pa.array(n)], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Words(NamedTuple):
    """The words with a number by their hashes; numbers begin at 2, the end of a text is 1."""

    h1: np.ndarray  # ascending
    h2: np.ndarray
    number: np.ndarray
    count: np.ndarray  # by number

    def numbers(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        if not len(self.h1):
            return np.zeros(len(h1), np.int32)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        return np.where((self.h1[at] == h1) & (self.h2[at] == h2), self.number[at], 0).astype(np.int32)


def hashes(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = H.buffer(found)
    return tuple(H.word_hashes(raw, offsets[:-1], offsets[1:], w) for w in (0, 1))


def frequent(table: DataFrame, least: int, ends: int) -> Words:
    """At most 1 / NUMBERED rows: the words' hashes and counts come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            h1, h2 = hashes(part.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), part.column(1)], ["h1", "h2", "c"])

    got = table.filter(F.col("c") >= least).mapInArrow(run, "h1 long, h2 long, c long").toArrow()
    h1, h2, c = (got.column(k).to_numpy() for k in range(3))
    h1, h2 = h1.view(H.U64), h2.view(H.U64)
    order = np.argsort(h1, kind="stable")
    h1, h2, c = h1[order], h2[order], c[order]
    often = np.argsort(-c, kind="stable")  # small numbers for frequent words, which pack well
    number = np.empty(len(c), np.int64)
    number[often] = np.arange(2, len(c) + 2)
    return Words(h1, h2, number, np.concatenate(([0, ends], c[often])))


def hashed(h1: np.ndarray) -> np.ndarray:
    """The numbers of words that the broadcast table does not hold."""
    return (h1 >> H.U64(2)).astype(np.int64) | HASHED


def mix(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), H.U64)
    for c in columns:
        out = H.mixed(out ^ c.astype(H.U64)) + H.U64(0x9E3779B97F4A7C15)
    return out


def places(digits: int, *columns: np.ndarray) -> np.ndarray:
    return (mix(*columns) >> H.U64(64 - digits)).astype(np.int64)


def bit_table(rows: DataFrame, names: Sequence[str]) -> np.ndarray:
    """A bit for the place of every row's ``names``: 2^BITS of them, whatever the rows."""
    digits = max(BITS, 3)
    each = 1 << max(min(PIECE, digits), 3)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            at = np.unique(places(digits, *(c.to_numpy(zero_copy_only=False) for c in part.columns)))
            yield pa.RecordBatch.from_arrays([pa.array(at // each), pa.array(at % each)], ["piece", "at"])

    def piece(found: pa.Table) -> pa.Table:
        bits = np.zeros(each, bool)
        bits[found.column("at").to_numpy()] = True
        return pa.table({"piece": found.column("piece")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    found = rows.select(*names).mapInArrow(put, "piece long, at long").distinct()
    got = found.groupBy("piece").applyInArrow(piece, "piece long, bits binary").toArrow()
    out = np.zeros((1 << digits) // 8, np.uint8)
    for k, bits in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
        out[k * each // 8 : (k + 1) * each // 8] = np.frombuffer(bits, np.uint8)
    return out


def in_table(bits: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    at = places((8 * len(bits)).bit_length() - 1, *columns)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def word_numbers(table: DataFrame) -> DataFrame:
    """(a): the hashes, as numbers, of the words of a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield pa.RecordBatch.from_arrays([pa.array(hashed(hashes(part.column(0))[0]))], ["a"])

    return table.select("word").mapInArrow(run, "a long")


def numbered(docs: DataFrame, known: Words, others: np.ndarray) -> DataFrame:
    """Rows (doc_id, held_out, text) to (slice, key, doc_id, held_out, n, tokens, hashed,
    rare): the numbers of all tokens, packed, apart from them those that are hashes (of
    words that the bits ``others`` let pass), and the words without a number in the
    broadcast table with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast((known, others))
    names = ["slice", "key", "doc_id", "held_out", "n", "tokens", "hashed", "rare"]
    kind = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        known, others = shared.value
        at_slice, held = 0, 0
        for part in slices(batches, "text"):
            found, first = words(part.column(3))
            found = found.dictionary_encode()
            of, distinct = found.indices.to_numpy(), len(found.dictionary)
            number, rest = np.empty(0, np.int32), np.empty(0, np.int64)
            if distinct:
                h1, h2 = hashes(found.dictionary)
                number, rest = known.numbers(h1, h2)[of], hashed(h1)
                rest = np.where(in_table(others, rest), rest, 0)[of]
            at = np.flatnonzero(number == 0)
            shown = np.where((number == 0) & (rest > 0), -1, number).astype("<i4")
            bounds = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
            packed = [pack(np.append(shown[b:e], np.int32(END)).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()) for b, e in bounds]
            apart = [pack(rest[b:e][shown[b:e] < 0].astype("<i8").tobytes()) for b, e in bounds]
            row = np.searchsorted(first, at, "right") - 1
            cell, times = np.unique(row * max(distinct, 1) + of[at], return_counts=True)
            row, word = np.divmod(cell, max(distinct, 1))
            pairs = pa.StructArray.from_arrays([found.dictionary.cast(pa.binary()).take(pa.array(word)), pa.array(times.astype(np.int64))], ["word", "times"])
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)), pairs)
            if held and held + len(of) > TOKENS:
                at_slice, held = at_slice + 1, 0
            held += len(of) + part.num_rows
            task = part.column(0).to_numpy() >> 33  # the partition, in Spark's increasing numbers
            # slices that shared a number would be one larger slice
            columns = [pa.array(((task % (1 << 19)) * (1 << 12) + min(at_slice, (1 << 12) - 1)).astype(np.int32)), *part.columns[:3], pa.array(np.diff(first).astype(np.int64) + 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary()), pa.array(apart, pa.binary()), rare.cast(kind)], names)

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "held_out", "text")
    schema = "slice int, key long, doc_id long, held_out boolean, n long, tokens binary, hashed binary, rare array<struct<word: binary, times: long>>"
    return keyed.mapInArrow(run, schema)


def sequences(packed: pa.Array, apart: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts, each after two 0 (no context), and where texts begin (n + 1)."""
    unpack = zstandard.ZstdDecompressor().decompress
    each = [np.ascontiguousarray(np.frombuffer(unpack(z), np.uint8).reshape(4, -1).T).view("<i4")[:, 0] for z in packed.to_pylist()]
    sizes = np.array([len(t) + 2 for t in each], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(begin[-1], np.int64)
    for t, b in zip(each, begin[:-1], strict=True):
        out[b + 2 : b + 2 + len(t)] = t
    out[out < 0] = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(unpack(z), "<i8") for z in apart.to_pylist())])
    return out, begin


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64 bits, the bytes of one place together."""
    planes = [c.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(planes))


def unpacked(data: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]


def found_at(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the ascending ``keys``, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def distinct_grams(tokens: np.ndarray, train: np.ndarray, bits: np.ndarray | None) -> Iterator[tuple[np.ndarray, ...]]:
    """(a, b, c, n), ascending, n: occurrences in training texts.  Without ``bits`` the
    words (b and c 0) and the pairs (c 0), with it the triples of pairs it lets pass."""
    ids, of = np.unique(tokens, return_inverse=True)
    many, none = len(ids), np.zeros(0, np.int64)

    def count(code: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        every, _ = np.unique(code, return_counts=True)  # by sorting
        some, times = np.unique(code[kept], return_counts=True)
        n = np.zeros(len(every), np.int64)
        n[np.searchsorted(every, some)] = times
        return every, n

    good = tokens > END
    if bits is None:
        at = np.flatnonzero(good)
        word, n = count(of[at], train[at])
        yield ids[word], np.zeros_like(n), np.zeros_like(n), n
    at = np.flatnonzero(good[:-1] & (tokens[1:] > 0)) if len(tokens) else none
    first, second = of[at], of[at + 1]
    if bits is None:
        pair, n = count(first * many + second, train[at])
        yield ids[pair // many], ids[pair % many], np.zeros_like(n), n
        return
    at = at[in_table(bits, ids[first], ids[second])]
    at = at[:-1][np.diff(at) == 1]  # a passing pair begins at its second word
    heads, head = np.unique(of[at] * many + of[at + 1], return_inverse=True)
    triple, n = count(head * many + of[at + 2], train[at])
    head = heads[triple // many]
    yield ids[head // many], ids[head % many], ids[triple % many], n


def gathered(texts: DataFrame, buckets: int, least: int, single: int, bits: np.ndarray | None = None) -> DataFrame:
    """(a, b, c, n, slices) of the frequent words and pairs, or of the frequent triples
    of pairs that ``bits`` let pass: training occurrences, and all slices that they lie
    in (none from ``single`` occurrences on)."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(at_slice: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            tokens, train = (np.concatenate(x) for x in zip(*parts, strict=True))
            for columns in distinct_grams(tokens, train, shared.value):
                if not len(columns[0]):
                    continue
                bucket = (mix(*columns[:3]) % H.U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                columns, bucket = [c[order] for c in columns], bucket[order]
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                data = []
                for b, e in zip(starts, [*starts[1:], len(bucket)], strict=True):
                    a, rest = columns[0][b:e], [c[b:e] for c in columns[1:]]
                    data.append(packed(np.diff(a, prepend=0), *rest))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array(np.full(len(starts), at_slice, np.int32)), pa.array(data, pa.binary())], ["bucket", "slice", "data"])

        now, parts = None, []
        for part in slices(batches, "tokens"):
            which = part.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(which)]
            for b, e in zip(cuts[:-1], cuts[1:], strict=True):
                if b == e:
                    continue
                if parts and which[b] != now:
                    yield from sent(now, parts)
                    parts = []
                now, piece = which[b], part.slice(b, e - b)
                tokens, begin = sequences(piece.column(2), piece.column(3))
                parts.append((tokens, np.repeat(~piece.column(1).to_numpy(zero_copy_only=False), np.diff(begin))))
        if parts:
            yield from sent(now, parts)

    def added(found: pa.Table) -> pa.Table:
        each = [unpacked(z, 4) for z in found.column("data").to_pylist()]
        a = np.concatenate([np.cumsum(x[0]) for x in each])
        b, c, n = (np.concatenate([x[k] for x in each]) for k in (1, 2, 3))
        of = np.repeat(np.arange(len(each), dtype=np.int32), [x.shape[1] for x in each])
        del each
        keys = mix(a, b, c)
        order = np.argsort(keys)
        keys = keys[order]
        a, b = a[order], b[order]
        c, n, of = c[order], n[order], of[order]
        differ = lambda: (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
        new = np.ones(len(a), bool)
        new[1:] = differ()
        agree = (new[1:] & (keys[1:] == keys[:-1])).any()
        del keys
        if agree:  # keys of 64 bits, by chance
            order = np.lexsort((c, b, a))
            a, b, c, n, of = (x[order] for x in (a, b, c, n, of))
            new[1:] = differ()
        starts = np.flatnonzero(new)
        total, size = np.add.reduceat(n, starts), np.diff(starts, append=len(a))
        kept = total >= least
        listed = kept & (total < single)
        lists = found.column("slice").to_numpy()[of[np.repeat(listed, size)]]
        offsets = np.concatenate(([0], np.cumsum(np.where(listed, size, 0)[kept]))).astype(np.int32)
        at = starts[kept]
        return pa.table([pa.array(a[at]), pa.array(b[at]), pa.array(c[at]), pa.array(total[kept]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists))],
                        ["a", "b", "c", "n", "slices"])

    sent = texts.select("slice", "held_out", "tokens", "hashed").mapInArrow(blocks, "bucket long, slice int, data binary")
    return stage(sent.groupBy("bucket").applyInArrow(added, "a long, b long, c long, n long, slices array<int>"))


def states(rows: DataFrame, context: Sequence[str], rest: str) -> DataFrame:
    """The contexts that are states, and the logarithm (base 10) of what their other
    symbols are multiplied with.  A row is a symbol: it follows its context, which occurs
    ``total`` times, ``n`` times; ``share``: its probability there, ``below``: in the
    shorter state."""
    left, least = F.greatest(1 - F.sum("share"), F.lit(1e-12)), F.lit(1e-12)
    found = rows.groupBy(*context).agg(
        (left / F.greatest(1 - F.sum("below"), least)).alias("_rest"),
        F.sum(F.col("n") * F.log(F.col("share") / F.col("below"))).alias("_gain"),
        F.greatest(F.max("total") - F.sum("n"), F.lit(0)).alias("_others"),
        F.count(F.lit(1)).alias("_symbols"),
    )
    better = F.col("_gain") + F.col("_others") * F.log("_rest") > COST * F.col("_symbols")
    return found.filter(better).select(*context, F.log10("_rest").alias(rest))


def added_logs(low: DataFrame, high: DataFrame, ends: int, total: int, single: int) -> tuple[DataFrame, DataFrame]:
    """What words (as contexts), pairs and triples add to the logarithms of the unigrams,
    wherever that is not 0: (a, b, c, w) of those with ``single`` occurrences, at most
    1 / NUMBERED of each length, and of the others (slice, data) for the slices they lie in."""
    share = ((F.col("n") - DISCOUNT) / F.col("total")).alias("share")
    found = low.filter("b = 0").select("a", "n")
    symbols = found.select(F.col("a").alias("b"), "n").unionByName(low.sparkSession.createDataFrame([(END, ends)], "b long, n long"))
    below = symbols.select("b", ((F.col("n") + 1) / F.lit(float(total))).alias("below"))
    pairs = stage(low.filter("b > 0").join(found.select("a", F.col("n").alias("total")), "a").join(below, "b").select("a", "b", "n", "total", share, "below"))
    ones = stage(states(pairs, ["a"], "rest1"))
    log, under = F.log10("share"), F.log10("below")
    is_state = F.col("rest1").isNotNull()
    pairs = stage(pairs.join(ones, "a", "left").select("a", "b", "n", F.when(is_state, log).otherwise(under).alias("log"),
                                                       F.when(is_state, log - F.col("rest1") - under).otherwise(0.0).alias("w")))
    triples = high.join(pairs.select("a", "b", F.col("n").alias("total")), ["a", "b"])
    triples = triples.join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), "log"), ["b", "c"])
    triples = stage(triples.select("a", "b", "c", "n", "total", share, F.pow(F.lit(10.0), "log").alias("below"), "log"))
    twos = stage(states(triples, ["a", "b"], "rest2"))
    parts = (
        (low.filter("b = 0"), ones.select("a", F.col("rest1").alias("w")), ["a"]),
        (low.filter("b > 0"), pairs.join(twos, ["a", "b"], "left").select("a", "b", (F.col("w") + F.coalesce("rest2", F.lit(0.0))).alias("w")), ["a", "b"]),
        (high, triples.join(twos, ["a", "b"]).select("a", "b", "c", (log - F.col("rest2") - F.col("log")).alias("w")), ["a", "b", "c"]),
    )
    each = [(grams, adds.filter("w != 0"), on) for grams, adds, on in parts]
    every = [grams.filter(F.col("n") >= single).select("a", "b", "c").join(adds, on).select("a", "b", "c", "w") for grams, adds, on in each]
    others = [grams.filter(F.col("n") < single).drop("n").join(adds, on).select("a", "b", "c", "w", "slices").mapInArrow(by_slice, "slice int, data binary")
              for grams, adds, on in each]
    return reduce(DataFrame.unionByName, every), reduce(DataFrame.unionByName, others)


def by_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, c, w, slices) to (slice, data), packed."""

    def sent(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        at, *columns = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((columns[0], at))
        at, columns = at[order], [c[order] for c in columns]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        data = [packed(*(c[b:e] for c in columns)) for b, e in zip(starts, [*starts[1:], len(at)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(at[starts].astype(np.int32)), pa.array(data, pa.binary())], ["slice", "data"])

    held, total = [], 0
    for part in batches:
        times = part.column(4).value_lengths().to_numpy(zero_copy_only=False)
        values = [c.to_numpy().view(np.int64) for c in part.columns[:4]]
        held.append([part.column(4).flatten().to_numpy(), *(np.repeat(v, times) for v in values)])
        total += len(held[-1][0])
        if total > SENT:
            yield sent(held)
            held, total = [], 0
    if total:
        yield sent(held)


class Adds(NamedTuple):
    """What words, pairs and triples add, by ascending keys."""

    ids: np.ndarray
    heads: np.ndarray  # the pairs that triples begin with
    keys: list[np.ndarray]
    values: list[np.ndarray]


def adds(a: np.ndarray, b: np.ndarray, c: np.ndarray, w: np.ndarray) -> Adds:
    ids, _ = np.unique(np.concatenate((a, b, c)), return_counts=True)
    place, many = lambda x: np.searchsorted(ids, x), len(ids) + 1
    one, two, three = b == 0, (b > 0) & (c == 0), c > 0
    heads, head = np.unique(place(a[three]) * many + place(b[three]), return_inverse=True)
    keys = [a[one], place(a[two]) * many + place(b[two]), head * many + place(c[three])]
    orders = [np.argsort(k) for k in keys]
    return Adds(ids, heads, [k[o] for k, o in zip(keys, orders, strict=True)], [w[m][o] for m, o in zip((one, two, three), orders, strict=True)])


def logs(tokens: np.ndarray, table: Adds) -> np.ndarray:
    """What the word before every token, the pair and the triple that end in it add."""
    many, out = len(table.ids) + 1, np.zeros(len(tokens))
    before = np.concatenate(([0], tokens[:-1]))
    at = found_at(table.ids, tokens)
    first = np.concatenate(([-1], at[:-1]))
    pair = np.where((first >= 0) & (at >= 0) & (before > END), first * many + at, -1)
    head = np.concatenate(([-1], found_at(table.heads, pair)[:-1]))  # the pair before
    wanted = (np.where(before > END, before, -1), pair, np.where((head >= 0) & (at >= 0), head * many + at, -1))
    for keys, values, want in zip(table.keys, table.values, wanted, strict=True):
        found = found_at(keys, want)
        out[found >= 0] += values[found[found >= 0]]
    return out


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (remainder(F.col(doc_id)) == HELD_OUT).alias("held_out"), F.col(text).alias("text"))
    table = stage(counted(docs.filter("not held_out and text is not null")))
    ends = docs.filter("not held_out").count()
    n_words, occurrences = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    n_tokens, n_words = occurrences + ends, n_words + (ends > 0)
    least = max(SUPPORT, math.ceil(LEAST * n_tokens))
    single = max(least, math.ceil(NUMBERED * n_tokens))
    known = frequent(table, single, ends)
    total = n_tokens + n_words + 1
    root = spark.sparkContext.broadcast(np.log10((known.count + 1) / total))

    others = bit_table(word_numbers(table.filter((F.col("c") >= least) & (F.col("c") < single))), ["a"])
    texts = stage(numbered(docs, known, others))
    buckets = 1 + n_tokens // BUCKET
    low = gathered(texts, buckets, least, single)
    high = gathered(texts, buckets, least, single, bit_table(low.filter("b > 0"), ["a", "b"]))
    often, sent = added_logs(low, high, ends, total, single)
    often = spark.sparkContext.broadcast(adds(*(c.to_numpy() for c in often.toArrow().columns)))

    # sums of the other words: decimals add up alike in any order
    rare = texts.select("key", F.explode("rare").alias("r")).select("key", "r.*").join(table.filter(F.col("c") < single), "word", "left")
    log = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(total))).cast("decimal(20,16)")
    sums = rare.groupBy("key").agg(
        F.sum((log * F.col("times").cast("decimal(12,0)")).cast("decimal(38,16)")).cast("double").alias("rare_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
    )

    def run(found: pa.Table, others: pa.Table) -> pa.Table:
        if not found.num_rows:
            return kind.empty_table()
        columns = found.combine_chunks()
        tokens, begin = sequences(columns.column("tokens"), columns.column("hashed"))
        have = (tokens > 0) & (tokens < HASHED)
        base = np.where(have, root.value[np.where(have, tokens, 0)], 0.0)
        model = base + logs(tokens, often.value)
        if others.num_rows:
            a, b, c, w = np.concatenate([unpacked(z, 4) for z in others.column("data").to_pylist()], axis=1)
            model += logs(tokens, adds(a, b, c, w.view(np.float64)))
        # a text's end is known where there are training rows
        seen = (have & (tokens > END)) | ((tokens == END) & (ends > 0))
        sums = [pa.array(np.add.reduceat(x, begin[:-1])) for x in (seen.astype(np.int64), base, model)]
        return pa.table([*(columns.column(k) for k in ("key", "doc_id", "held_out", "n")), *sums], kind.names)

    kind = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                      ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    mine = texts.select("slice", "key", "doc_id", "held_out", "n", "tokens", "hashed").groupBy("slice")
    known_part = mine.cogroup(sent.groupBy("slice")).applyInArrow(
        run, "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    plus = lambda c, more, kind: (F.col(c) + F.coalesce(more, F.lit(0).cast(kind))).alias(c)
    return known_part.join(sums, "key", "left").select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "rare_known", "long"), F.lit(n_tokens).cast("long").alias("train_tokens"),
        plus("base_score", "rare_log", "double"), plus("score", "rare_log", "double"))
