"""Connected components over long chains, against union-find."""

import random

import pytest

from panelforge.llm.common import components


def smallest(links):
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def chain(ids, width=1):
    return [(a, b) for k in range(1, width + 1) for a, b in zip(ids, ids[k:])]


def shuffled(n, seed):
    ids = list(range(n))
    random.Random(seed).shuffle(ids)
    return ids


@pytest.mark.parametrize(
    "links",
    [
        chain([0, *range(400, 0, -1)]),
        chain(shuffled(600, 1)) + chain([1000 + i for i in shuffled(300, 2)], 5),
        [(i, 500) for i in range(500)] + [(700, 600), (600, 700)],
    ],
    ids=["falling", "shuffled", "star"],
)
def test_components_of_any_diameter(spark, links):
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == smallest(links) and len(got) == len({x for link in links for x in link})


def test_no_links(spark):
    links = spark.createDataFrame([(3, 3), (None, 1)], "a long, b long")
    assert components(links).collect() == []
