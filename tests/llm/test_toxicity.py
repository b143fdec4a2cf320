"""Toxicity: the automaton against edit distances, held-out accuracy, edge cases."""

import random
import zlib

import pytest

from panelforge.llm import toxicity
from panelforge.llm.common import table
from panelforge.llm.queries import op3_toxicity
from panelforge.llm.toxicity import FUZZY, Automaton, Term


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row = _next(row, i, c, b)
    return row[-1]


def _next(row, i, c, b):
    out = [i]
    for j, d in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (c != d)))
    return out


def expected(word, terms):
    """Least edits over all terms (an open stem: over all prefixes of the word)."""
    best = None
    for t in terms:
        for end in range(len(word) + 1) if t.open else [len(word)]:
            w = word[:end]
            if w[:1] != t.text[:1]:
                continue
            d = distance(w[1:], t.text[1:])
            if d == 0 or (d == 1 and len(t.text) >= FUZZY):
                best = d if best is None else min(best, d)
    return best


def test_automaton_equals_edit_distance():
    rnd = random.Random(1)
    terms = [Term(w, o, 5.0) for w, o in (("idiot", False), ("scum", False), ("lowei", True), ("pathetic", False), ("chll", True), ("trash", False), ("idle", False), ("tramp", False))]
    automaton = Automaton(terms)
    words = [t.text for t in terms] + ["idio", "iddiot", "idiott", "didiot", "ydiot", "loweixyz", "lowwixyz", "lewi", "chllabc", "chla", "scu", "scumm", "i", ""]
    for t in terms:
        for _ in range(150):
            w = list(t.text + "".join(rnd.choice("abi") for _ in range(rnd.randint(0, 2))))
            for _ in range(rnd.randint(0, 2)):
                at = rnd.randrange(len(w))
                w[at : at + rnd.randint(0, 1)] = [rnd.choice("aeilostcrh")] * rnd.randint(0, 1)
                w = w or ["x"]
            words.append("".join(w))
    for w in words:
        got = automaton.find(w)
        assert (got[1] if got else None) == expected(w, terms), w


def text(rnd, n):
    return ["".join(rnd.choice("aeinrstou") for _ in range(rnd.randint(3, 8))) for _ in range(n)]


def corpus(rnd, n):
    """Toxic: a term somewhere, at times misspelled; clean: none, or a term inside a quotation."""
    docs, labels = [], []
    for i in range(n):
        words, kind = text(rnd, 60), rnd.random()
        term = rnd.choice(["idiot", "moron", "worthless", "scumbag", "vermin"])
        if kind < 0.3:
            at = rnd.randrange(2, len(term))
            words.insert(rnd.randrange(60), rnd.choice([term] * 4 + [term[:at] + "z" + term[at:]]))
        elif kind < 0.36:
            at = rnd.randrange(50)
            words[at:at] = ["they", "said", f'"you {term} there"', "reported"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(kind < 0.3)))
    return docs, labels


def test_learns_terms_misspellings_and_quotation(spark):
    rnd = random.Random(2)
    docs, labels = corpus(rnd, 3000)
    n = len(docs)
    extra = [(n, " ".join(text(rnd, 40)) + " morzon"), (n + 1, None), (n + 2, ""), (None, " ".join(text(rnd, 9)) + " Idiot!"), (n + 3, " ".join(text(rnd, 40_000)) + " vermin"), (5, docs[5][1])]
    df = spark.createDataFrame([(*d, 0) for d in docs + extra], "doc_id long, text string, score int")
    lab = spark.createDataFrame([(*x, "q") for x in labels] + [(None, 1, "q"), (n + 1, None, "q"), (n + 2, 7, "q"), (6, 1 - labels[6][1], "q")], "doc_id long, toxic int, quality string")
    rows = toxicity.judged(df, lab).collect()
    assert len(rows) == len(docs) + len(extra)
    got = {r["doc_id"]: r for r in rows}
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d, _ in docs + extra if d is not None and zlib.crc32(str(d).encode()) % 5 == 0}
    true = dict(labels)
    right = [r["predicted"] == true[r["doc_id"]] for r in held if r["doc_id"] in true]
    assert sum(right) >= 0.95 * len(right)
    assert got[n]["predicted"] == 1 and got[None]["predicted"] == 1 and got[n + 3]["predicted"] == 1
    assert got[n + 1]["predicted"] == got[n + 2]["predicted"] == 0 and got[n + 1]["score"] == got[n + 2]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_no_labels_no_rows(spark):
    docs = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.judged(docs, none).collect()] == [0.5]
    assert toxicity.judged(docs.limit(0), none).count() == 0


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    got = op3_toxicity(spark, sf).join(table(spark, sf, "labels").filter("toxic is not null"), "doc_id").filter("held_out").collect()
    hits = [r["predicted"] == r["toxic"] for r in got]
    assert len(hits) > 20 and sum(hits) >= 0.9 * len(hits)


@pytest.mark.parametrize("bad", ['he wrote "you idiot"', "> idiot", "“idiot”", "«idiot»"])
def test_quoted(bad):
    (hit,) = toxicity.hits(bad, Automaton([Term("idiot", False, 1.0)]))
    assert hit.quoted
    (bare,) = toxicity.hits('"x" idiot', Automaton([Term("idiot", False, 1.0)]))
    assert not bare.quoted


def plain(word, terms):
    """Least edits over all terms (an open stem: over all prefixes of the word), the first letter like any other."""
    ends = lambda t: range(len(word) + 1) if t.open else [len(word)]
    found = [(distance(word[:end], t.text), t) for t in terms for end in ends(t)]
    return min((d for d, t in found if d == 0 or (d == 1 and len(t.text) >= FUZZY)), default=None)


def test_edits_at_the_first_letter():
    rnd = random.Random(4)
    terms = [Term(w, o, 5.0) for w, o in (("idiot", False), ("scum", False), ("lowei", True), ("pathetic", False), ("chll", True), ("trash", False), ("idle", False))]
    automaton = Automaton(terms, any_first=True)
    words = ["ldiot", "xdiot", "diot", "xidiot", "didiot", "diott", "oweixyz", "xloweixyz", "zoweia", "cum", "ycum", "hll", "", "i"]
    for t in terms:
        for _ in range(200):
            w = list(t.text + "".join(rnd.choice("abi") for _ in range(rnd.randint(0, 2))))
            for _ in range(rnd.randint(0, 2)):
                at = rnd.choice([0, 0, rnd.randrange(len(w))])
                w[at : at + rnd.randint(0, 1)] = [rnd.choice("aeilostcrh")] * rnd.randint(0, 1)
                w = w or ["x"]
            words.append("".join(w))
    for w in words:
        got = automaton.find(w)
        assert (got[1] if got else None) == plain(w, terms), w


def test_judged_finds_terms_misspelled_at_the_first_letter(spark):
    docs, labels = corpus(random.Random(2), 3000)
    extra = [(10_000 + i, " ".join(text(random.Random(i), 40)) + f" {w}") for i, w in enumerate(["xorthless", "orthless", "zworthless"])]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string")
    rows = toxicity.judged(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert all(r["terms"] for r in rows if r["doc_id"] >= 10_000)


FAR = "word " * 100


@pytest.mark.parametrize(
    ("line", "quoted"),
    [
        (f'he wrote "{FAR} idiot', True),
        (f"> {FAR} idiot", True),
        (f"  > {FAR} idiot", True),
        (f"“{FAR} idiot", True),
        (f'"{FAR[:300]}" {FAR[:300]} idiot', False),
        (f'"x {FAR}" idiot', False),
        (f"«{FAR}» {FAR} idiot", False),
        (f"„{FAR}“ {FAR} idiot", False),
        (f'> "{FAR}\n{FAR} idiot', False),
    ],
)
def test_quotation_that_begins_far_before(line, quoted):
    assert [h.quoted for h in toxicity.hits(line, Automaton([Term("idiot", False, 1.0)]))] == [quoted]


def test_the_sample_is_bounded_by_rows_and_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "word " * (i + 1)) for i in range(30)] + [(30, None), (31, "x" * 5000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(32)], "doc_id long, toxic int")
    assert toxicity.sampled(docs, labels).count() == 32
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 1000)
    some = toxicity.sampled(docs, labels).collect()
    assert 5 < len(some) < 32 and sum(len(r["text"] or "") for r in some) <= 1000
    monkeypatch.setattr(toxicity, "SAMPLE", 7)
    assert toxicity.sampled(docs, labels).count() <= 7
