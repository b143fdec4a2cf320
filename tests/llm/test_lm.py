"""Language-model scoring against plain dictionaries."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelforge.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Brute:
    """The same tree by its definition, over dictionaries."""

    def __init__(self, rows):
        train = [tokens(t) for i, t in rows if not held(i)]
        self.c = Counter(w for t in train for w in t)
        self.N, self.V = sum(self.c.values()), len(self.c)
        least = max(lm.SUPPORT, math.ceil(lm.LEAST * self.N))
        frequent = {w for w, n in self.c.items() if n >= least and w is not None}
        good = lambda w: w is None or w in frequent
        pairs = Counter((a, b) for t in train for a, b in zip(t, t[1:]) if a in frequent and good(b))
        pairs = {k: n for k, n in pairs.items() if n >= least}
        triples = Counter((a, b, c) for t in train for a, b, c in zip(t, t[1:], t[2:]) if (a, b) in pairs and (b, c) in pairs)
        self.states = {}
        nexts = defaultdict(dict)
        for (a, b), n in pairs.items():
            nexts[(a,)][b] = n
        for (a, b, c), n in triples.items():
            if n >= least:
                nexts[(a, b)][c] = n
        for s in sorted(nexts, key=len):
            total = self.c[s[0]] if len(s) == 1 else pairs[s]
            share = {w: (n - lm.DISCOUNT) / total for w, n in nexts[s].items()}
            below = {w: self.p(s[1:], w) for w in share}
            rest = (1 - sum(share.values())) / (1 - sum(below.values()))
            gain = sum(n * math.log(share[w] / below[w]) for w, n in nexts[s].items()) + (total - sum(nexts[s].values())) * math.log(rest)
            if gain > lm.COST * len(share):
                self.states[s] = (share, rest)

    def root(self, w):
        return (self.c.get(w, 0) + 1) / (self.N + self.V + 1)

    def p(self, history, w):
        for k in (2, 1):
            s = tuple(history[-k:])
            if len(s) == k and s in self.states:
                share, rest = self.states[s]
                return share[w] if w in share else rest * self.p(s[1:], w)
        return self.root(w)

    def row(self, i, text):
        t = tokens(text)
        base = sum(math.log10(self.root(w)) for w in t)
        score = sum(math.log10(self.p(tuple(t[max(0, k - 2) : k]), w)) for k, w in enumerate(t))
        return (i, held(i), len(t), sum(self.c.get(w, 0) > 0 for w in t), self.N, base, score)


def corpus(n=300, seed=4):
    r = random.Random(seed)
    phrase = "the Cat sat on the mat and the dog lay by the door".split()
    rows = []
    for i in range(n):
        w = []
        while len(w) < r.randrange(3, 60):
            w += phrase[: r.randrange(2, 13)] if r.random() < 0.5 else [r.choice(["the", "a", "of", f"rare{r.randrange(400)}", "ÉTÉ"])]
        rows.append((i, " ".join(w)))
    return rows


def got(spark, rows):
    out = lm.scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    return sorted(map(tuple, out), key=str)


def same(mine, other):
    other = sorted(other, key=str)
    assert [r[:5] for r in mine] == [r[:5] for r in other]
    assert np.allclose([r[5:] for r in mine], [r[5:] for r in other], rtol=1e-10, atol=1e-9)


def test_against_dictionaries(spark):
    rows = corpus() + [(500, None), (501, ""), (None, "the cat sat"), (None, "new"), (502, "word\x00x \x0b the\ncat"), (503, "the cat sat on " * 3000), (7, "the cat"), (7, "the cat")]
    brute = Brute(rows)
    assert {len(s) for s in brute.states} == {1, 2}
    mine = got(spark, rows)
    same(mine, [brute.row(*r) for r in rows])
    assert sum(r[6] - r[5] for r in mine if r[1]) > 50  # better than unigrams on held-out rows


def test_every_state_sums_to_one():
    brute = Brute(corpus())
    everything = [*brute.c, "unknown word"]
    for s in [(), *brute.states]:
        assert abs(sum(brute.p(s, w) for w in everything) - 1) < 1e-9


def test_thresholds_by_share(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEAST", 0.01)
    monkeypatch.setattr(lm, "TOKENS", 50)
    rows = corpus(80)
    same(got(spark, rows), [Brute(rows).row(*r) for r in rows])


def test_no_training_rows(spark):
    i = next(i for i in range(100) if held(i))
    assert got(spark, [(i, "a b")]) == [(i, True, 3, 0, 0, 0.0, 0.0)]


def test_empty(spark):
    assert got(spark, []) == []


@pytest.mark.parametrize("name", ["key", "n", "tokens", "c"])
def test_clashing_columns(spark, name):
    df = spark.createDataFrame([(1, "a b", 3), (2, None, None)], f"doc_id long, text string, {name} int")
    same(sorted(map(tuple, lm.scored(df).collect()), key=str), [Brute([(1, "a b"), (2, None)]).row(*r) for r in [(1, "a b"), (2, None)]])


def test_no_share_is_asked_for(spark):
    """Nine occurrences are enough in a corpus of more than nine times 2^20 tokens, as in a small one."""
    i = next(i for i in range(100) if not held(i))
    few = [(j, "pqr stu vwx") for j in range(1000, 2000) if not held(j)][:9]
    mine = got(spark, [(i, "a " * 9_600_000), *few])
    n, base = 9_600_001 + 36, math.log10(10 / (9_600_001 + 36 + 5 + 1))
    for r in mine:
        if r[0] != i:
            assert r[4] == n and r[6] > r[5] + 5  # "stu" nearly always follows "pqr"
            assert abs(r[5] - (3 * base + math.log10(11 / (n + 6)))) < 1e-9


def test_words_without_a_number(spark, monkeypatch):
    """Few words have numbers, texts lie in many slices, and the bit tables let much pass."""
    for name, value in (("NUMBERED", 0.02), ("TOKENS", 50), ("BUCKET", 300), ("BITS", 4)):
        monkeypatch.setattr(lm, name, value, raising=False)
    rows = corpus(200) + [(500, None), (None, "the cat sat on the mat")]
    brute = Brute(rows)
    assert {len(s) for s in brute.states} == {1, 2}
    same(got(spark, rows), [brute.row(*r) for r in rows])
