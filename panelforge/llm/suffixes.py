"""Operator 6: dedup of repeated byte strings with suffix arrays.

Where strings of ``LENGTH`` bytes repeat is read from suffix arrays of bounded
buckets.  Each such string names an anchor, the least hash among its
``GRAM``-byte grams, so equal strings meet in the bucket of their anchor.  A
segment is the stretch of text that holds all strings of one anchor's place.
Segments that are equal (by a 128-bit digest of their bytes) are one, and so are
equal texts: every string of theirs repeats, which needs no array.  A bucket with
different segments is read as cells of ``CELL`` bytes counted from the anchor (equal
strings have equal cells), and the suffix array of the cells, by linear grouping,
brings together the starts that share all whole cells of a string; a cell is eight
bytes as one number, as are the broken cells at a string's two ends together, so
nothing in an array is compared by a hash.  A bucket with very many segments is
split by the strings themselves, which are counted by two hashes modulo 2^61 - 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelforge.llm import hashing as H
from panelforge.llm.common import bounds, runs, slices, stage, unzipped, zipped
from panelforge.llm.gsaca import suffix_array
from panelforge.llm.substrings import covered

#: Bytes of a string, of the grams that anchor it, and of a cell.
LENGTH, GRAM, CELL = 200, 40, 8
#: Cells of one suffix array, and segments of a bucket that is not split.
SYMBOLS, SEGMENTS = 100_000, 8_000
#: Bytes of a text that are anchored at once; positions within fit in PLACE bits.
PIECE, PLACE = 8_000_000, 24

SPAN = LENGTH - GRAM + 1


class Windows:
    """Strings of one text: for each start the place and hash of its anchor."""

    def __init__(self, raw: np.ndarray):
        self.count = max(0, len(raw) - LENGTH + 1)
        places, hashes = [], []
        for at in range(0, self.count, PIECE):
            grams = H.grams(raw[at : at + PIECE + LENGTH - 1], GRAM)
            ranked = (grams >> H.U64(PLACE) << H.U64(PLACE)) | np.arange(len(grams), dtype=H.U64)
            least = (H.sliding_min(ranked, SPAN) & H.U64((1 << PLACE) - 1)).astype(np.int64)
            places.append(least + at)
            hashes.append(grams[least])
        self.place = np.concatenate(places) if places else np.empty(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.empty(0, H.U64)

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First start, number of starts, place and hash of every anchor's place."""
        if not self.count:
            none = np.empty(0, np.int64)
            return none, none, none, np.empty(0, H.U64)
        first = np.flatnonzero(np.concatenate(([True], self.place[1:] != self.place[:-1])))
        return first, np.diff(np.append(first, self.count)), self.place[first], self.hash[first]


def texts_of(part: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    raw, offsets = H.buffer(part.column(part.schema.get_field_index("text")))
    for i in range(part.num_rows):
        yield i, raw[offsets[i] : offsets[i + 1]]


def _rows(out: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)], names=names)


def described(docs: DataFrame) -> DataFrame:
    """doc_id, t1, t2 (the text's identity), n_bytes, sha, the text's anchors, and
    those of them that have several places in it (``again``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n, sha, lists = [], [], ([], [])
            for _, raw in texts_of(part):
                n.append(len(raw))
                sha.append(hashlib.sha256(raw.tobytes()).hexdigest())
                hashes, times = np.unique(Windows(raw).segments()[3], return_counts=True)
                lists[0].append(hashes.view(np.int64))
                lists[1].append(hashes[times > 1].view(np.int64))
            arrays = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]).astype(np.int32)), pa.array(np.concatenate(x))) for x in lists]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(n, pa.int64()), pa.array(sha), *arrays], names=["doc_id", "t1", "t2", "n_bytes", "sha", "anchors", "again"])

    schema = "doc_id bigint, t1 bigint, t2 bigint, n_bytes bigint, sha string, anchors array<bigint>, again array<bigint>"
    return docs.select("doc_id", "t1", "t2", "text").mapInArrow(run, schema)


def segments(texts: DataFrame) -> DataFrame:
    """(a, s1, s2, t1, first, n): the segments of the anchors in column ``anchors``,
    by their 128-bit identity, with first start and number of starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unzipped(batches):
            out = []
            for i, raw in texts_of(part):
                first, n, place, a = Windows(raw).segments()
                met = np.isin(a, part.column(2)[i].values.to_numpy().view(H.U64))
                first, n, place, a = first[met], n[met], place[met], a[met]
                cuts = zip(first.tolist(), (first + n + LENGTH - 1).tolist(), (place - first).tolist(), strict=True)
                data = memoryview(raw)
                ids = b"".join([hashlib.blake2b(data[b:e], digest_size=16, salt=at.to_bytes(4, "little")).digest() for b, e, at in cuts])
                s1, s2 = np.frombuffer(ids, "<i8").reshape(-1, 2).T
                out.append((a.view(np.int64), s1, s2, np.full(len(a), part.column(0)[i].as_py(), np.int64), first, n))
            yield _rows(out, ["a", "s1", "s2", "t1", "first", "n"], [pa.int64()] * 5 + [pa.int32()])

    return texts.select("t1", "text", "anchors").mapInArrow(run, "a bigint, s1 bigint, s2 bigint, t1 bigint, first bigint, n int")


def cut_out(texts: DataFrame) -> DataFrame:
    """The bytes of the wanted segments: rows (t1, text, wanted) to (a, open, t1,
    first, n, anchor, data), ``anchor`` being its place in ``data``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unzipped(batches):
            rows = []
            for i, raw in texts_of(part):
                t1, places = part.column(0)[i].as_py(), Windows(raw).place
                for w in part.column(2)[i].as_py():
                    lo = w["first"]
                    rows.append((w["a"], w["open"], t1, lo, w["n"], int(places[lo]) - lo, raw[lo : lo + w["n"] + LENGTH - 1].tobytes()))
            names = ["a", "open", "t1", "first", "n", "anchor", "data"]
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return texts.select("t1", "text", "wanted").mapInArrow(run, "a bigint, open boolean, t1 bigint, first bigint, n int, anchor int, data binary")


def repeated_starts(data: list[bytes], anchor: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For the starts of all segments, in their order: is the string that starts
    there found at another start of these segments?"""
    raw = np.frombuffer(b"".join(data), np.uint8)
    offset = np.cumsum([0, *map(len, data)])
    lane = H.lanes(raw)
    begin, end = offset[:-1], offset[1:]
    lead = anchor % CELL  # bytes before the first whole cell
    cells = (end - begin - lead) // CELL
    cell_of = np.concatenate(([0], np.cumsum(cells + 1)))  # a separator after each segment
    seg = np.repeat(np.arange(len(data)), cells)
    nth = np.arange(len(seg)) - np.repeat(np.cumsum(cells) - cells, cells)
    at = begin[seg] + lead[seg] + nth * CELL
    _, value = np.unique(lane[at], return_inverse=True)
    symbols = np.zeros(cell_of[-1], np.int64)  # separators are the smallest symbol
    spots = cell_of[seg] + nth
    symbols[spots] = value + 1
    left = np.zeros(len(symbols), np.int64)  # whole cells from here to the segment's end
    left[spots] = cells[seg] - nth

    whole = LENGTH // CELL - 1
    order = suffix_array(symbols)
    same = np.ones(max(0, len(order) - 1), bool)
    padded = np.concatenate((symbols, np.full(whole, -1)))
    for k in range(whole):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
    same &= (left[order[1:]] >= whole) & (left[order[:-1]] >= whole)
    shared = np.empty(len(symbols), np.int64)
    shared[order] = np.cumsum(np.concatenate(([0], ~same)))

    who = np.repeat(np.arange(len(data)), n)
    start = begin[who] + (np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n))
    cell = -(-(start - begin[who] - lead[who]) // CELL)
    cell = np.maximum(cell, 0)
    cell_at = begin[who] + lead[who] + cell * CELL
    # head and tail of a string have CELL bytes together
    ahead = cell_at - start
    head, tail = H.first_bytes(lane[start], ahead), H.first_bytes(lane[cell_at + whole * CELL], CELL - ahead)
    key = np.stack((shared[cell_of[who] + cell].astype(H.U64), ahead.astype(H.U64), head, tail))
    by = np.lexsort(key)
    equal = (key[:, by[1:]] == key[:, by[:-1]]).all(axis=0)
    found = np.zeros(len(who), bool)
    found[by[1:]] |= equal
    found[by[:-1]] |= equal
    return found


def spans(found: np.ndarray, first: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> list[tuple[int, int, int]]:
    """(segment, begin, end) of the runs of found starts of the wanted segments, as starts of their text."""
    out = []
    ends = np.cumsum(n)
    for i in np.flatnonzero(wanted).tolist():
        part = np.concatenate(([False], found[ends[i] - n[i] : ends[i]], [False]))
        for b, e in np.flatnonzero(part[1:] != part[:-1]).reshape(-1, 2).tolist():
            out.append((i, int(first[i]) + b, int(first[i]) + e))
    return out


SPANS = "t1 bigint, b bigint, e bigint"


def by_suffix_array(cut: DataFrame) -> DataFrame:
    """(t1, b, e): runs of repeated starts of the open segments, bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "a"):
            col = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("a", "open", "t1", "first", "n", "anchor")}
            data = table.column("data").to_pylist()
            size = np.cumsum([0, *(len(d) // CELL + 1 for d in data)])
            lo = 0
            groups = bounds(col["a"])
            for k, (_, hi) in enumerate(groups):  # whole buckets, several to an array
                if k + 1 < len(groups) and size[groups[k + 1][1]] - size[lo] <= SYMBOLS:
                    continue
                found = repeated_starts(data[lo:hi], col["anchor"][lo:hi], col["n"][lo:hi])
                rows = spans(found, col["first"][lo:hi], col["n"][lo:hi], col["open"][lo:hi])
                lo_, lo = lo, hi
                if rows:
                    i, b, e = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(col["t1"][lo_ + np.array(i)]), pa.array(b, pa.int64()), pa.array(e, pa.int64())], names=["t1", "b", "e"])

    return cut.repartition("a").sortWithinPartitions("a").mapInArrow(run, SPANS)


def by_string(cut: DataFrame) -> DataFrame:
    """The same for buckets that are split: their strings are counted one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "data"):
            out = []
            for i in range(part.num_rows):
                raw = np.frombuffer(part.column(part.schema.get_field_index("data"))[i].as_py(), np.uint8)
                h1, h2 = (H.windows(raw.astype(H.U64) + H.U64(1), LENGTH, w).view(np.int64) for w in (0, 1))
                fixed = [np.full(len(h1), part.column(part.schema.get_field_index(c))[i].as_py(), np.int64) for c in ("t1", "open")]
                out.append((h1, h2, fixed[0], fixed[1], part.column(part.schema.get_field_index("first"))[i].as_py() + np.arange(len(h1))))
            yield _rows(out, ["h1", "h2", "t1", "open", "b"], [pa.int64()] * 5)

    each = cut.mapInArrow(run, "h1 bigint, h2 bigint, t1 bigint, open bigint, b bigint")
    twice = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2")
    return each.filter("open = 1").join(twice, ["h1", "h2"]).select("t1", "b", (F.col("b") + 1).alias("e"))


def removed(texts: DataFrame) -> DataFrame:
    """Rows (t1, text, runs of starts) to (t1, spans, kept bytes); spans holds begin
    and end of the maximal removed runs, in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unzipped(batches):
            spans_, kept = [], []
            for i, raw in texts_of(part):
                marks = np.zeros(len(raw) + 1, np.int32)
                for r in part.column(2)[i].as_py():
                    marks[r["b"]] += 1
                    marks[r["e"]] -= 1
                gone = covered(len(raw), np.flatnonzero(np.cumsum(marks[:-1]) > 0), LENGTH)
                spans_.append(np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).reshape(-1, 2).tolist())
                kept.append(raw[~gone].tobytes())
            kind = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans_, kind), pa.array(kept, pa.binary())], names=["t1", "spans", "kept"])

    return texts.select("t1", "text", "runs").mapInArrow(run, "t1 bigint, spans array<array<bigint>>, kept binary")


def deduplicated(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, texts) of rows (doc_id, text).

    documents: doc_id, t1, n_bytes, sha (digest of the whole text) and copy (is
    there an equal text of ``LENGTH`` bytes or more); texts: t1, spans and kept
    bytes of the texts from which something goes because parts are found
    elsewhere.  A copy goes whole.  Null and empty texts have no bytes; null ids
    and repeated rows are documents like others (repeated texts repeat every
    string).  An empty table gives empty results; further columns are ignored."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))
    facts = stage(described(docs))
    copies = facts.filter(F.col("n_bytes") >= LENGTH).groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("t1", "t2", F.lit(True).alias("copy"))
    documents = facts.drop("anchors", "again").join(copies, ["t1", "t2"], "left").withColumn("copy", F.coalesce("copy", F.lit(False))).drop("t2")

    places = facts.select("t1", F.explode("anchors").alias("a"))
    across = places.groupBy("a").agg(F.min("t1").alias("lo"), F.max("t1").alias("hi")).filter("lo < hi").select("a")
    met = across.unionByName(facts.select(F.explode("again").alias("a"))).distinct()
    open_ = places.join(met, "a").groupBy("t1").agg(F.collect_set("a").alias("anchors"))
    once = zipped(docs.select("t1", "text")).groupBy("t1").agg(F.first("text").alias("text"))
    texts = stage(once.join(open_, "t1"))

    places = stage(segments(texts))
    kinds = stage(places.groupBy("a", "s1", "s2").agg(F.min(F.struct("t1", "first", "n")).alias("o"), F.count(F.lit(1)).alias("c")))
    whole = places.join(kinds.filter("c > 1").select("s1", "s2"), ["s1", "s2"]).select("t1", F.col("first").alias("b"), (F.col("first") + F.col("n")).alias("e"))
    buckets = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("k"), F.count_if(F.col("c") == 1).alias("u")).filter("k > 1 and u > 0").select("a", "k")
    wanted = stage(kinds.join(buckets, "a").select("o.t1", "a", (F.col("c") == 1).alias("open"), "o.first", "o.n", "k"))

    def cut(rows: DataFrame) -> DataFrame:
        listed = rows.groupBy("t1").agg(F.collect_list(F.struct("a", "open", "first", "n")).alias("wanted"))
        return cut_out(texts.join(listed, "t1"))

    found = by_suffix_array(cut(wanted.filter(F.col("k") <= SEGMENTS)))
    large = wanted.filter(F.col("k") > SEGMENTS)
    if not large.isEmpty():
        found = found.unionByName(by_string(cut(large)))
    marks = stage(whole.unionByName(found).groupBy("t1").agg(F.collect_list(F.struct("b", "e")).alias("runs")))
    return documents, removed(texts.join(marks, "t1"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    documents, texts = deduplicated(docs)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))
    slim = texts.select("t1", size.alias("n"), F.size("spans").cast("long").alias("k"), F.sha2("kept", 256).alias("left"))
    pick = lambda copied, changed, same: F.when(F.col("copy"), copied).otherwise(F.coalesce(changed, same))
    zero = F.lit(0).cast("long")
    return documents.join(slim, "t1", "left").select(
        "doc_id",
        "n_bytes",
        pick(F.col("n_bytes"), F.col("n"), zero).alias("n_removed"),
        pick(F.lit(1).cast("long"), F.col("k"), zero).alias("n_spans"),
        pick(F.lit(hashlib.sha256().hexdigest()), F.col("left"), F.col("sha")).alias("kept_sha256"),
    )
