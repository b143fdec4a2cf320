"""The corpus pipeline: every stage against its own rule, and the whole run."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelforge.llm import bpe, pii, quality
from panelforge.llm.queries import PATTERN, RANKS
from test_jaccard import shingles
from test_mixing import targets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("aeinrstoulm") for _ in range(rnd.randint(3, 7))) for _ in range(400)]
    out = []
    for i in range(120):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(60, 160))]
        if i % 10 == 0:
            words[5] = "jane.roe@example.org"
        out.append((i, " ".join(words), rnd.choice(["en", "de"]), rnd.choice(["a", "b", "c", None])))
    for i in range(0, 30, 3):  # near copies of smaller and of larger id
        words = out[i][1].split()
        words[40] = "changed"
        out.append((1000 + i, " ".join(words), "en", "a"))
    out += [(-5, out[7][1], "en", "c"), (2000, "too short", "en", "a"), (2001, None, "en", "a"), (2002, "", None, None)]
    out += [out[3], (None, " ".join(rnd.choice(vocab) for _ in range(90)), "en", "a")]
    out.append((2003, " ".join(rnd.choice(vocab) for _ in range(80)) + " ####" * 300, "en", "b"))
    return [(*r, len(r[1] or "")) for r in out]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.createDataFrame(rows(), SCHEMA), []
    for name, step in corpus_pipeline.STAGES:
        after = corpus_pipeline.stage(step(spark, docs, ""))
        out.append((name, docs, after))
        docs = after
    return out


def test_order_and_columns(stages):
    assert [n for n, *_ in stages] == ["quality rules", "n-gram Jaccard join", "PII", "mixing sources", "byte-level BPE"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_quality(stages):
    _, before, after = stages[0]
    kept = Counter((r["doc_id"], r["n_words"]) for r in quality.judged(before).filter("kept").collect())
    assert Counter((r["doc_id"], len(r["text"].split())) for r in after.collect()) == kept
    left = {r["doc_id"] for r in after.collect()}
    assert not left & {2000, 2001, 2002, 2003} and set(range(120)) <= left


def groups(texts):
    sets = list(map(shingles, texts))
    root = list(range(len(sets)))

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return list(map(find, range(len(sets))))


def one_of_each(rows):
    least = {}
    for r, g in zip(rows, groups([r["text"] for r in rows]), strict=True):
        least[g] = min(least.get(g, (True, 0)), (r["doc_id"] is None, r["doc_id"] or 0))
    return Counter(None if none else i for none, i in least.values())


def test_near_duplicates(stages):
    _, before, after = stages[1]
    assert Counter(r["doc_id"] for r in after.collect()) == one_of_each(before.collect())


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rnd = random.Random(2)
    text = lambda: " ".join(rnd.choice("abcdefghijklmn") * rnd.randint(1, 4) for _ in range(40))
    a, b, c = text(), text(), text()
    rows = [(1, a, 0), (1, b, 1), (1, c, 2), (2, a, 3), (None, b, 4), (None, c + " x", 5), (None, text(), 6), (3, a, 7), (1, a, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key int")
    out = corpus_pipeline.near_duplicates(spark, df, "").collect()
    assert Counter(r["doc_id"] for r in out) == one_of_each(df.collect()) == Counter({1: 3, None: 1})
    assert {r["text"] for r in out} >= {a, b, c}


def test_clashing_columns(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).withColumns({c: F.lit(7) for c in ("_key", "_n", "_i", "_row", "_found", "_W")})
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, ""))
        assert docs.columns[-6:] == ["_key", "_n", "_i", "_row", "_found", "_W"]
    got = docs.select("_key", "_n", "_i", "_row", "_found", "_W").distinct().collect()
    assert [tuple(r) for r in got] == [(7,) * 6] and docs.count() > 50


def test_personal_data(stages):
    _, before, after = stages[2]
    want = {r["doc_id"]: r["text"] for r in pii.pseudonymised(before).collect()}
    got = {r["doc_id"]: r for r in after.collect()}
    assert {k: r["text"] for k, r in got.items()} == want
    assert all("jane.roe" not in r["text"] and r["n_chars"] == len(r["text"]) for r in got.values())


def test_mixing(stages):
    _, before, after = stages[3]
    size, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before.collect():
        n = len(r["text"].split())
        size[r["source"]] += n
        longest[r["source"]] = max(longest[r["source"]], n)
    for r in after.collect():
        taken[r["source"]] += len(r["text"].split())
    want = targets(size)
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in size)
    assert max(Counter(map(tuple, after.collect())).values()) <= 3


def test_tokens(stages):
    _, before, after = stages[4]
    codec, want = bpe.codec(RANKS, PATTERN), Counter()
    for r in before.collect():
        ids = codec.encode(r["text"])
        want[r["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()] += 1
    assert Counter(map(tuple, after.collect())) == want


def test_run_and_empty_table(spark, stages, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/a/documents.parquet")
    got = Counter(map(tuple, corpus_pipeline.run(spark, f"{tmp_path}/a").collect()))
    assert got == Counter(map(tuple, stages[-1][2].collect())) and np.sum(list(got.values())) > 50
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0
