"""Substring dedup against brute force."""

import hashlib
import random
import re

from panelforge.llm import substrings

N = substrings.WINDOW


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows):
    least = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - N + 1):
            key = tuple(w[i : i + N])
            if doc_id is not None:
                least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - N + 1):
            if doc_id is not None and least[tuple(w[i : i + N])] < doc_id:
                gone.update(range(i, i + N))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rnd = random.Random(3)
    vocab = ["é" * k + c for k in range(3) for c in "abcdefg"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage, line = text(80), text(49)
    rows = [(10, text(200)), (11, passage), (12, text(30) + "\n" + passage + "\t" + text(90)), (13, passage + " " + passage)]
    rows += [(14, line + " " + text(30)), (15, text(20) + " " + line), (16, "a " * 300), (17, "a " * 70), (18, "A " * 70)]
    base = words(text(400))
    for k in range(12):  # near copies
        copy = list(base)
        copy[rnd.randrange(400)] = "x"
        rows.append((100 + k, " ".join(copy)))
    rows += [(19, None), (20, ""), (21, "   \n"), (None, passage), (5, passage[:-1]), (12, passage), (11, passage), (22, text(30_000))]
    rows += [(k, passage) for k in range(200, 230)]
    # words that differ in every letter, by the pattern on which polynomials modulo 2^64 agree
    for k, n in enumerate((256, 2048, 4096)):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        rest = text(60).split()
        rows += [(300 + 2 * k, " ".join(rest[:25] + [word] + rest[25:49])), (301 + 2 * k, " ".join(rest[:25] + [word.translate({97: 98, 98: 97})] + rest[25:49]))]
    return rows


def test_equals_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, anchors string, n_words int")
    got = sorted(map(tuple, substrings.digests(df).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.digests(df).count() == 0
