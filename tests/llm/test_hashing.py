"""Hashes of words and windows."""

import numpy as np
from hypothesis import given, settings, strategies as st

from panelforge.llm import hashing as H

FAR = st.integers(0, (1 << 64) - 1)


def words(texts):
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    return [H.word_hashes(raw, *H.word_bounds(raw, np.array([0, len(raw)]))[:2], w) for w in (0, 1)]


@given(st.lists(st.integers(0, H.PRIME + 7), min_size=1, max_size=20), st.lists(st.integers(0, H.PRIME + 7), min_size=1, max_size=20))
@settings(max_examples=200, deadline=None)
def test_products(a, b):
    n = min(len(a), len(b))
    got = H.times(np.array(a[:n], H.U64), np.array(b[:n], H.U64))
    assert [int(x) % H.PRIME for x in got] == [x * y % H.PRIME for x, y in zip(a, b, strict=False)] and (got <= H.PRIME + 7).all()


@given(st.lists(FAR, min_size=1, max_size=60), st.integers(1, 8), st.integers(0, 3))
@settings(max_examples=200, deadline=None)
def test_windows_are_polynomials(values, length, base):
    b = H._BASES[base]
    want = [sum(v * pow(b, k, H.PRIME) for k, v in enumerate(values[i : i + length])) % H.PRIME for i in range(len(values) - length + 1)]
    assert H.windows(np.array(values, H.U64), length, base).tolist() == H.mixed(np.array(want, H.U64)).tolist()


def test_patterned_words_stay_apart():
    texts = []
    for n in (64, 256, 1024, 2048, 8192):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(n)).encode()
        texts += [word, word.translate(bytes.maketrans(b"ab", b"ba"))]
    assert all(len(set(h.tolist())) == len(texts) for h in words(texts))


def test_words_of_all_lengths():
    rnd = np.random.default_rng(1)
    texts = [bytes(rnd.integers(33, 126, n, dtype=np.uint8)) for n in [*range(1, 40), 255, 256, 257, 5000]]
    for h in words([*texts, *texts]):
        assert h[: len(texts)].tolist() == h[len(texts) :].tolist() and len(set(h.tolist())) == len(texts)
    assert all(len(set(h.tolist())) == 4 for h in words([b"a", b"a\0", b"a\0\0", b"\0a"]))
