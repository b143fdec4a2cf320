"""Byte-level BPE: against the tiktoken library, and an exact round trip."""

import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from panelforge.llm import bpe
from panelforge.llm.queries import PATTERN, RANKS


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(library):
    codec, rnd = bpe.codec(RANKS, PATTERN), random.Random(7)
    texts = ["", " ", "a" * 1001, " " * 777, "ab" * 500 + "é" * 300, "\n" * 99 + "x", "zq" * 2000, "<|endoftext|> 's 'LL"]
    texts += ["".join(rnd.choice("aeinrst  QZ9#\n\té中🙂") for _ in range(rnd.randint(1, 200))) for _ in range(400)]
    texts += ["".join(rnd.choice("aeinrstoldh") for _ in range(rnd.randint(30, 300))) for _ in range(200)]
    for text in texts:
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text), text
        assert codec.decode(packed) == text.encode()


def test_tree_equals_direct_merging():
    codec, rnd = bpe.codec(RANKS, PATTERN), random.Random(8)
    for _ in range(100):
        data = "".join(rnd.choice("thearon") for _ in range(rnd.randint(60, 400))).encode()
        assert codec.encode_piece(data) == codec.leaf(data)


LONG = {
    "one letter": "a", "a rule": "=", "a dash": "-", "two": "ab", "three": "abc", "a word": "theand", "wide": "é", "line": "=-+",
}


@pytest.mark.parametrize("kind", LONG)
def test_long_matches(library, kind):
    codec, unit = bpe.codec(RANKS, PATTERN), LONG[kind]
    for n in (2049, 5000, 40_013):
        text = (unit * n)[:n]
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)
    text, began = unit * (1_000_000 // len(unit)), time.process_time()
    packed = codec.encode(text)
    assert time.process_time() - began < 20 and codec.decode(packed) == text.encode()


def test_rounds_and_heap_equal_direct_merging(monkeypatch):
    codec, rnd = bpe.codec(RANKS, PATTERN), random.Random(9)
    for k in range(120):
        alphabet = rnd.choice(["ab", "the", "aaab", "=-", "etaoinshrdlu", "\x00é"])
        data = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 300))).encode()
        direct = codec.leaf(data)
        assert codec.rounds(data) == direct
        assert codec.heaped([codec.ranks[bytes([b])] for b in data]) == direct
        monkeypatch.setattr(bpe, "ROUNDS", k % 4)
        assert codec.rounds(data) == direct
        monkeypatch.undo()


def test_every_token_encodes_to_itself():
    codec = bpe.codec(RANKS, PATTERN)
    assert all(codec.leaf(token) == [rank] for token, rank in codec.ranks.items())


def test_frame_nulls_repeats_clashing_names(spark, library):
    long = "word é" * 300_000
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (3, "", "y"), (4, long, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.digests(df, RANKS, PATTERN).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.digests(df.limit(0), RANKS, PATTERN).count() == 0
