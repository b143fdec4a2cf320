"""Operator 1: byte-level BPE encoding and decoding as a monoid tree reduction.

``join`` makes token lists a monoid: the encoding of a concatenation from the
encodings of its two parts.  Only a window around the seam is encoded again;
it grows until its first and last token fit their outer neighbours.  Two
neighbouring tokens fit when encoding their joint bytes gives just these two,
and a token list is the encoding of its bytes exactly when all neighbours fit,
so nothing outside the window can change.  ``encode_piece`` reduces a piece as a
tree of such joins, ``decode`` concatenates up the same kind of tree.

The work on a match of n bytes stays near n.  A window is merged by rounds over
arrays, one for each rank, or from a heap where the rounds are many.  In a
periodic match, where windows grow to the whole, halves are alike: a left part
is a power of two long, and of two equal halves one is encoded.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.common import slices

#: Bytes of a piece that are merged directly; longer ones are halved.
LEAF = 24
#: Bytes from which a window is merged by rounds, and rounds after which a heap goes on.
LARGE, ROUNDS = 2048, 48
NONE = 1 << 60
#: Pieces, and pairs of neighbours, whose answers a worker remembers.
MEMO = 500_000
#: Matches handled at once, and token ids concatenated at a leaf.
RUN = 100_000


class Codec:
    """Encoder and decoder for one rank file (``base64-token rank`` lines)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def leaf(self, data: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until none is left."""
        if len(data) >= LARGE:
            return self.rounds(data)
        rank = self.ranks.get
        starts = list(range(len(data) + 1))
        merges = [rank(data[i : i + 2], NONE) for i in range(len(data) - 1)]
        while merges and (least := min(merges)) < NONE:
            at = merges.index(least)
            del starts[at + 1], merges[at]
            if at < len(merges):
                merges[at] = rank(data[starts[at] : starts[at + 2]], NONE)
            if at:
                merges[at - 1] = rank(data[starts[at - 1] : starts[at + 1]], NONE)
        return [self.ranks[data[i:j]] for i, j in zip(starts, starts[1:], strict=False)]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that neighbours (by their numbers) would merge into."""
        pairs, at = np.unique(left * len(self.tokens) + right, return_inverse=True)
        rank, token = self.ranks.get, self.tokens
        found = [rank(token[p // len(token)] + token[p % len(token)], NONE) for p in pairs.tolist()]
        return np.array(found, np.int64)[at]

    def rounds(self, data: bytes) -> list[int]:
        """``leaf`` by whole arrays: all places of the lowest rank merge at once, which
        is what one by one would do as long as no token that a merge makes (before or
        after its neighbours' merges) joins a neighbour at a still lower rank."""
        tokens = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)[np.frombuffer(data, np.uint8)]
        merges = self.pair_ranks(tokens[:-1], tokens[1:])
        for _ in range(ROUNDS):
            least = int(merges.min(initial=NONE))
            if least == NONE:
                return tokens.tolist()
            at = np.flatnonzero(merges == least)
            # of places that overlap, every second one from the left
            first = np.concatenate(([True], np.diff(at) > 1))
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))) % 2 == 0]
            merged = tokens.copy()
            merged[at] = least
            after = at[at + 2 < len(tokens)] + 2
            before = at[at > 0] - 1
            gone = np.zeros(len(tokens), bool)
            gone[at + 1] = True
            left = np.where(gone[before], merged[before - 1], merged[before])
            made = np.concatenate((self.pair_ranks(np.full(len(after), least), tokens[after]), self.pair_ranks(left, np.full(len(before), least))))
            if made.min(initial=NONE) < least:
                break
            tokens = merged[~gone]
            merges = np.delete(merges, at)  # a merged place's rank goes, its neighbours' change
            spot = at - np.arange(len(at))
            for changed in (spot[spot < len(merges)], spot[spot > 0] - 1):
                merges[changed] = self.pair_ranks(tokens[changed], tokens[changed + 1])
        return self.heaped(tokens.tolist())

    def heaped(self, tokens: list[int]) -> list[int]:
        """``leaf`` from a state of it, with the next merges on a heap."""
        rank, token = self.ranks.get, self.tokens
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank(token[tokens[i]] + token[tokens[i + 1]], NONE)) < NONE]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if tokens[i] < 0 or j >= n or rank(token[tokens[i]] + token[tokens[j]], NONE) != r:
                continue
            tokens[i], tokens[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (s := rank(token[r] + token[tokens[after[i]]], NONE)) < NONE:
                    heapq.heappush(heap, (s, i))
            if (h := before[i]) >= 0 and (s := rank(token[tokens[h]] + token[r], NONE)) < NONE:
                heapq.heappush(heap, (s, h))
        return [t for t in tokens if t >= 0]

    def fit(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            known = self.pairs[left, right] = self.leaf(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the joint bytes, from the encodings of both parts."""
        if not left or not right or self.fit(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.leaf(b"".join(map(self.tokens.__getitem__, left[len(left) - i :] + right[:j])))
            outer_left = i == len(left) or self.fit(left[len(left) - i - 1], window[0])
            outer_right = j == len(right) or self.fit(window[-1], right[j])
            if outer_left and outer_right:
                return left[: len(left) - i] + window + right[j:]
            i, j = i * (1 if outer_left else 2), j * (1 if outer_right else 2)

    def encode_piece(self, data: bytes) -> list[int]:
        if (rank := self.ranks.get(data)) is not None:
            return [rank]
        if len(data) <= LEAF:
            return self.leaf(data)
        half = 1 << (len(data) - 1).bit_length() - 1
        left = self.encode_piece(data[:half])
        return self.join(left, left if data[half:] == data[:half] else self.encode_piece(data[half:]))

    def packed(self, piece: str) -> bytes:
        if len(self.pieces) >= MEMO:
            self.pieces.clear()
        out = self.pieces[piece] = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        known, out = self.pieces, []
        matches = (m.group() for m in self.pattern.finditer(text)) if len(text) > 50 * RUN else iter(self.pattern.findall(text))
        while run := list(islice(matches, RUN)):
            out.append(b"".join([known.get(p) or self.packed(p) for p in run]))
        return b"".join(out)

    def decode(self, packed: bytes | None) -> bytes:
        if not packed:
            return b""
        n = len(packed) // 4
        if n <= RUN:
            return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        half = n // 2 * 4
        return self.decode(packed[:half]) + self.decode(packed[half:])


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, read once in each Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _mapped(df: DataFrame, source: str, target: str, fn_name: str, path: str, pattern: str) -> DataFrame:
    kept = [c for c in df.columns if c not in (source, target)]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = getattr(codec(path, pattern), fn_name)
        for part in slices(batches, source):
            values = part.column(part.schema.get_field_index(source)).to_pylist()
            out = [part.column(part.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*out, pa.array(map(fn, values), pa.binary())], names=[*kept, target])

    return df.select(*(f"`{c}`" for c in kept), f"`{source}`").mapInArrow(run, (schema + ", " if kept else "") + f"`{target}` binary")


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Replace column ``text`` by ``ids``: the token ids as packed little-endian
    unsigned 32-bit integers.  Each match of ``pattern`` is encoded separately;
    special tokens are ordinary text.  Null and empty texts have no ids; other
    columns (nulls included) and repeated rows pass through."""
    return _mapped(df, text, ids, "encode", path, pattern)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """Replace packed ``ids`` by the bytes ``data`` that they stand for (null: empty)."""
    return _mapped(df, ids, data, "decode", path, pattern)


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes."""
    coded = encode(df.select("doc_id", "text"), path, pattern).withColumn("packed", F.col("ids"))
    back = decode(coded.select("doc_id", F.col("packed"), "ids"), path, pattern)
    return back.select(
        "doc_id",
        (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
