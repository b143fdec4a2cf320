"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter

import pytest

from panelforge.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=10):
    terms = lambda t: TERM.findall((t or "").translate(UPPER))
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_all = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    merged = {}
    for i, t in set(items):
        merged.setdefault(i, []).extend(terms(t))
    out = []
    for item, words in merged.items():
        scores = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // n_all
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in words if c[w])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def got(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical.ranked(d, i, **more).collect()), key=str)


DOCS = [
    (1, "The cat's cat, the-cat. ÉTÉ été x1 1x"), (2, "cat"), (3, None), (4, ""), (5, ";;; \x00\n"), (6, "concatenate cat\x00dog"),
    (7, "dog " * 500 + "CAT"), (8, "cat"), (8, "cat"), (None, "cat"), (9, "Été dog x1"), (10, "a" * 5000 + " cat"),
]


def test_brute_force(spark):
    items = [(1, "cat CAT dog"), (2, "été x1"), (3, None), (4, "?!"), (5, "nothing here"), (6, "cat"), (6, "cat"), (6, "dog"), (None, "dog"), (7, "ÉTÉ")]
    assert got(spark, DOCS, items) == brute(DOCS, items)


def test_batches_agree(spark, monkeypatch):
    items = [(i, f"cat dog{i} x{i % 2} " + "dog " * (i % 3)) for i in range(12)]
    docs = DOCS + [(100 + i, f"dog{i} x1 cat " * (i + 1)) for i in range(30)]
    whole = got(spark, docs, items)
    monkeypatch.setattr(lexical, "TERM_BYTES", 60)
    assert got(spark, docs, items) == whole == brute(docs, items)


def test_tasks_keep_the_best(spark):
    docs = [(i, "cat " * (1 + i % 7) + f"pad{i} " * (i % 5)) for i in range(400)]
    assert got(spark, docs, [(1, "cat pad3")], top=3) == brute(docs, [(1, "cat pad3")], 3)
    best = lexical.Best(1, 2)
    for score, i in ((5, 9), (5, 3), (7, 8), (5, 1)):
        best.add(*(lexical.np.array([x]) for x in (0, score, 0, i)))
        best.settle()
    assert best.rows[1].tolist() == [7, 5] and best.rows[3].tolist() == [8, 1]


@pytest.mark.parametrize("docs, items", [([], [(1, "cat")]), (DOCS, []), ([], []), ([(1, None)], [(1, "cat")])])
def test_empty(spark, docs, items):
    assert got(spark, docs, items) == []


def test_clashing_columns(spark):
    d = spark.createDataFrame([(1, "cat", 5, 6, 7)], "doc_id long, text string, id int, score int, rank int")
    i = spark.createDataFrame([(1, "cat", 5, 6)], "item_id long, text string, item int, part int")
    assert [tuple(r) for r in lexical.ranked(d, i).collect()] == brute([(1, "cat")], [(1, "cat")])
