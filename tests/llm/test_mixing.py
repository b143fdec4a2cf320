"""Mixing: targets against the iterative rule, the cube method's guarantees."""

import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from panelforge.llm import mixing


def targets(sizes):
    """The contract's rule, literally: shares by weight, stops, excess reshared."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    out, free, left = {}, set(order), Fraction(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = Fraction(3 * sizes[s])
            left -= 3 * sizes[s]
        free -= over
    return out


def rows(seed, per):
    rnd = random.Random(seed)
    out, k = [], 0
    for source, n in per.items():
        for _ in range(n):
            out.append((k, " ".join("w" * 1 for _ in range(int(rnd.lognormvariate(4, 1)))), source, 9))
            k += 1
    return out


PER = {"a": 400, "b": 50, "é": 300, "src10": 20, "src2": 700, "z": 1, None: 200, "": 30}


@pytest.mark.parametrize("block", [mixing.BLOCK, 16])
def test_mixture(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    data = rows(1, PER)
    data += [(None, "x y", "a", 9), (7, None, "b", 9), (8, "", "b", 9), data[0], data[0], (99_999, "w " * 50_000, "src2", 9), (5, "", "empty", 9)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, size int")
    got = mixing.mix(df).collect()
    assert len(got) == len(data)
    sizes = defaultdict(int)
    for _, text, source, _ in data:
        sizes[source] += len((text or "").split())
    want = targets(sizes)
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12)
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert np.floor(rate) <= r["copies"] <= np.ceil(rate)
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s, t in taken.items():
        assert abs(t - want[s]) <= max(2, longest[s])
        if len([1 for r in got if r["source"] == s]) >= 200 and s != "src2":
            assert abs(t - want[s]) <= 0.02 * want[s]
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_flight_keeps_totals_and_probabilities():
    rng = np.random.default_rng(3)
    x = rng.integers(1, 200, 40).astype(float)
    p = rng.uniform(0.1, 0.9, 40)
    seen = np.zeros(40)
    for k in range(2000):
        q = mixing.flight(p, x, np.random.default_rng(k))
        assert abs(q.sum() - p.sum()) < 1e-6 and abs(q @ x - p @ x) < 1e-4
        assert ((q > 0) & (q < 1)).sum() <= 2
        seen += q
    assert np.abs(seen / 2000 - p).max() < 0.06


def test_empty_table_and_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")).collect()
    assert [(r["target"], r["taken"]) for r in got] == [(0.0, 0)] * 2
