"""NN-descent near-duplicates against brute force."""

import random

import numpy as np
import pytest

from panelforge.llm import neighbours

BAD = [None, [], [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [1.0] * 15]


def brute(rows):
    good = []
    for vec_id, v in rows:
        ok = vec_id is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)
        good.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(good):
        for j, y in enumerate(good[:i]):
            if x is not None and y is not None and len(x) == len(y) and x @ y >= 0.95:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i, (vec_id, _) in enumerate(rows):
        if good[i] is not None:
            groups.setdefault(find(i), []).append(vec_id)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        component = min(groups[find(i)]) if good[i] is not None else vec_id
        out.append((vec_id, n[i], component, vec_id is not None and vec_id == component))
    return sorted(out, key=str)


def fixture(clusters, single, seed=1, dim=16):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(dim) for _ in range(single)]
    for size in clusters:
        centre = rng.standard_normal(dim)
        rows += [centre + rng.standard_normal(dim) * 0.08 * np.linalg.norm(centre) / 4 for _ in range(size)]
    ids = rng.permutation(len(rows)).tolist()
    rows = [(i, np.float32(v).tolist()) for i, v in zip(ids, rows, strict=True)]
    rows += [(10_000 + k, v) for k, v in enumerate(BAD)] + [(None, rows[0][1])]
    rows += [(20_000 + k, rows[3][1]) for k in range(30)] + [rows[5]] * 3 + [(30_000, [2 * c for c in rows[7][1]]), (30_001, [1.0, 2.0]), (30_002, [2.0, 4.0])]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [neighbours.BLOCK, 16])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows = fixture([2] * 40 + [5] * 10 + [60], 500)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, n_links int")
    got, want = sorted((tuple(r) for r in neighbours.linked(df).collect()), key=str), brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    links, found = sum(w[1] for w in want), sum(g[1] for g in got)
    assert found <= links and found >= 0.98 * links
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.97 * len(want)


def test_empty_and_unusable_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.linked(spark.createDataFrame([], schema)).count() == 0
    got = neighbours.linked(spark.createDataFrame(list(enumerate(BAD)), schema)).collect()
    assert sorted(tuple(r) for r in got) == [(i, 0, i, True) for i in range(len(BAD))]


def variants(groups, dim=16, seed=3):
    """Groups of two variants of 20: cosine 0.99 inside a variant, 0.953 or more between."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
        for side in (a, 0.96 * a + 0.28 * b):
            noise = rng.standard_normal((20, dim))
            rows += list(side + 0.02 * noise / np.linalg.norm(noise, axis=1, keepdims=True))
    rows += list(rng.standard_normal((200, dim)))
    return [(i, v.tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize("centres", [1024, 3])
def test_variants_of_one_group_are_joined(spark, monkeypatch, centres):
    monkeypatch.setattr(neighbours, "CENTRES", centres, raising=False)
    rows = variants(5)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = sorted((tuple(r) for r in neighbours.linked(df).collect()), key=str), brute(rows)
    assert [w[1] for w in want if w[0] < 200] != [19] * 200
    assert got == want


def hot_and_pairs(dim=16, seed=5):
    """A hot group of 300 and 150 lone pairs at cosine 0.955."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(dim)
    rows = [centre + rng.standard_normal(dim) * 0.02 * np.linalg.norm(centre) / 4 for _ in range(300)]
    for _ in range(150):
        a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
        rows += [a, 0.955 * a + (1 - 0.955**2) ** 0.5 * b]
    return [(i, v.tolist()) for i, v in enumerate(rows)]


def test_a_hot_group_does_not_hide_lost_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TABLES", 1)
    monkeypatch.setattr(neighbours, "RUN", 8)
    monkeypatch.setattr(neighbours, "ROUNDS", 1)
    rows = hot_and_pairs()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = ({r[0]: r[1] for r in x if r[0] >= 300} for x in (neighbours.linked(df).collect(), brute(rows)))
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)


def test_a_search_without_gain_fails(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ATTEMPTS", 1)
    monkeypatch.setattr(neighbours, "audit", lambda *_: 0.0)
    df = spark.createDataFrame(variants(1), "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError):
        neighbours.linked(df)
