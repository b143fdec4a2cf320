"""Suffix arrays, and the dedup of repeated byte strings, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from panelforge.llm import suffixes
from panelforge.llm.gsaca import suffix_array

N = suffixes.LENGTH


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_suffix_array(part, times):
    text = part * times
    assert suffix_array(np.array(text, np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows):
    seen = Counter()
    datas = [(d, (t or "").encode()) for d, t in rows]
    for _, data in datas:
        seen.update(data[i : i + N] for i in range(len(data) - N + 1))
    out = []
    for doc_id, data in datas:
        gone = bytearray(len(data))
        for i in range(len(data) - N + 1):
            if seen[data[i : i + N]] > 1:
                gone[i : i + N] = b"\1" * N
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture(seed):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("abcdeé \n") for _ in range(n))
    shared = [text(rnd.randint(150, 420)) for _ in range(6)]
    rows = [(k, text(rnd.randint(0, 300)) + rnd.choice(shared) + text(rnd.randint(0, 100)) + rnd.choice(shared)[rnd.randint(0, 60) :]) for k in range(40)]
    base = text(900)
    for k in range(15):  # near copies
        copy = list(base)
        copy[rnd.randrange(900)] = "#"
        rows.append((100 + k, "".join(copy)))
    rows += [(200, "a" * 199), (201, "a" * 200), (202, "b" * 201), (203, "ab" * 400), (204, None), (205, ""), (None, shared[0] + "x" * 250)]
    for k, n in enumerate((300, 2048)):  # polynomials modulo 2^64 agree on these
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        rows += [(400 + 2 * k, "<" + word + ">" + text(200)), (401 + 2 * k, text(200) + "<" + word.translate({97: 98, 98: 97}) + ">")]
    rows += [(300, base)] * 3 + [(301, "short")] * 2 + [(302, text(60_000) + base[:400])]
    return rows


@pytest.mark.parametrize("segments", [suffixes.SEGMENTS, 3])
def test_equals_brute_force(spark, monkeypatch, segments):
    monkeypatch.setattr(suffixes, "SEGMENTS", segments)
    rows = fixture(segments)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, anchors string")
    assert sorted(map(tuple, suffixes.digests(df).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert suffixes.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
