"""Quality rules: base figures against brute force, and the adaptive verdicts."""

import random
import re
from collections import Counter

import numpy as np

from panelforge.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(n - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_base_figures(spark):
    rnd = random.Random(4)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "é🙂 # é🙂\n\né🙂 # é🙂\r\n", "x\x0by\x0cz x y z", "\u00a0 \u2003 a"]
    texts += ["".join(rnd.choice("ab  \n#é") for _ in range(rnd.randint(0, 400))) for _ in range(150)]
    texts += [" ".join(rnd.choice(["the", "of", "and"] + [f"w{i}" for i in range(k)]) for _ in range(n)) for k, n in ((3, 300), (300, 20_000), (9, 2000))]
    rows = [(i, t, rnd.choice(["en", None]), "s", 5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = {r["doc_id"]: r for r in quality.judged(df).collect()}
    for i, t, *_ in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(t), (i, t)
        assert not (r["base_failed"] and r["kept"])


def prose(rnd, n):
    return " ".join("".join(rnd.choice("aeinrst") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def test_verdicts_follow_language_and_source(spark):
    rnd = random.Random(5)
    rows = [(i, prose(rnd, rnd.randint(60, 200)), "en", "a") for i in range(300)]
    rows += [(1000 + i, prose(rnd, 80) + " # " * 10, "en", "symbols") for i in range(300)]  # a source with symbols throughout
    rows += [(2000, prose(rnd, 100) + " ###" * 200, "en", "a"), (2001, prose(rnd, 80) + " # " * 10, "en", "symbols")]
    rows += [(2002, " ".join("x" * 40 for _ in range(1)) + " " + " ".join(prose(rnd, 60).split()[k] * 9 for k in range(60)), "en", "a")]
    rows += [(3000 + i, prose(rnd, 100), None, None) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(df).collect()}
    assert all(kept[i] for i in range(300)) and kept[2001] and all(kept[3000 + i] for i in range(3))
    assert np.mean([kept[1000 + i] for i in range(300)]) == 1
    assert not kept[2000] and not kept[2002]
    assert sorted(r["doc_id"] for r in quality.filtered(df).collect()) == sorted(k for k, v in kept.items() if v)
    assert quality.filtered(df).columns == df.columns


def test_sketch_quantiles_within_one_percent_and_mergeable(spark):
    rnd = random.Random(6)
    values = [rnd.lognormvariate(0, 2) for _ in range(5000)] + [0.0] * 100
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "part int, m double")
    merged = quality.merged(quality.sketches(df, ["part"], ["m"]), [])
    got = quality.quantiles(merged, [], {"a": 0.1, "b": 0.5, "c": 0.9}).first()
    for name, q in (("a", 0.1), ("b", 0.5), ("c", 0.9)):
        true = sorted(values)[int(np.ceil(q * len(values))) - 1]
        assert abs(got[name] - true) <= 0.0101 * true


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality.judged(df).count() == 0 and quality.filtered(df).count() == 0
