"""Operator 7: quality rules with adaptive thresholds from mergeable quantile sketches.

DataFrame functions only.  A sketch is a histogram over logarithmic bins (bin
``b`` holds the values in (G^(b-1), G^b]): counts per bin add up, so sketches of
partitions, sources and languages merge by addition, and a quantile read from
one is within 1 % of a true value.  Thresholds are fences around the median in
quartile ranges of the document's own language and source; a group with few
documents takes the merged sketch of its language, then that of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from panelforge.llm.common import stage

#: A word, and what is between words, in Java's regular expressions.
BREAK = r"[ \t-\r]+"
BREAKS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]+"
#: Growth of the bins: a quantile is exact to 1 %.
G = 1.02
#: Documents from which a group's own sketch is used.
LEAST = 200
#: metric -> (quartile ranges below, above the median, least quartile range)
FENCES = {
    "symbol_share": (None, 8.0, 0.0125),
    "dup_line_share": (None, 8.0, 0.05),
    "repeat_share": (None, 8.0, 0.05),
    "word_length": (6.0, 6.0, 0.25),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_list(text: Column) -> Column:
    inner = F.btrim(text, F.lit(BREAKS))
    return F.when(F.coalesce(F.length(inner), F.lit(0)) > 0, F.split(inner, BREAK)).otherwise(F.array().cast("array<string>"))


def repeated_words(words: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more.

    A window's 64-bit hash gives up its low bits to the position, so that one
    sort of plain longs brings equal windows together."""

    def counted(ws: Column) -> Column:
        n = F.size(ws)
        mask = let(F.ceil(F.log2(F.greatest(n, F.lit(2)).cast("double"))).cast("int"), lambda bits: F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)

        def masked(low: Column) -> Column:
            keys = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))

            def hits(s: Column) -> Column:
                same = lambda a, b: a.bitwiseXOR(b).bitwiseAND(F.bitwise_not(low)) == 0
                near = lambda k, i: F.coalesce(same(k, F.get(s, i - 1)), F.lit(False)) | F.coalesce(same(k, F.get(s, i + 1)), F.lit(False))
                places = F.sort_array(F.transform(F.filter(s, near), lambda k: k.bitwiseAND(low)))
                gaps = lambda ps: F.transform(ps, lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(ps, i + 1) - p, F.lit(3).cast("long"))))
                return let(places, lambda ps: F.aggregate(gaps(ps), F.lit(0).cast("long"), lambda a, g: a + g))

            return let(F.sort_array(keys), hits)

        return F.when(n < 3, F.lit(0).cast("long")).otherwise(let(mask, masked))

    return let(words, counted)


def measures(docs: DataFrame) -> DataFrame:
    """Base figures of every whole text, by the columns named in the module's
    query; null texts have no words.  All other columns are kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = word_list(text)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^ \t-\r]"))
    figures = let(
        words,
        lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), repeated_words(ws).alias("n_repeat_words")),
    )
    return docs.withColumns(
        {
            "_w": figures,
            "_l": let(lines, lambda ls: F.struct(F.size(ls).cast("long").alias("n"), F.size(F.array_distinct(ls)).cast("long").alias("d"))),
            "word_chars": F.length(F.regexp_replace(text, BREAK, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
        }
    ).withColumns(
        {
            "n_words": F.col("_w.n_words"),
            "n_lines": F.col("_l.n"),
            "n_dup_lines": F.col("_l.n") - F.col("_l.d"),
            "n_repeat_words": F.col("_w.n_repeat_words"),
        }
    ).drop("_w", "_l")


def sketches(values: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """(keys, metric, bin, n): the sketches of ``metrics`` by ``keys``; bin null holds 0."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics)))
    long = values.select(*keys, pairs.alias("_p")).select(*keys, "_p.metric", "_p.v").filter("v is not null")
    number = F.when(F.col("v") > 0, F.ceil(F.log("v") / math.log(G)).cast("int"))
    return long.groupBy(*keys, "metric", number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))


def quantiles(parts: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """(keys, metric, total, one column per quantile) read from merged sketches."""
    by = W.partitionBy(*keys, "metric")
    parts = parts.withColumn("_c", F.sum("n").over(by.orderBy(F.col("bin").asc_nulls_first()))).withColumn("_t", F.sum("n").over(by))
    value = F.when(F.col("bin").isNull(), F.lit(0.0)).otherwise(F.pow(F.lit(G), F.col("bin") - 0.5))
    picks = [F.min(F.when(F.col("_c") >= F.lit(q) * F.col("_t"), value)).alias(name) for name, q in at.items()]
    return parts.groupBy(*keys, "metric").agg(F.first("_t").alias("total"), *picks)


def thresholds(values: DataFrame) -> DataFrame:
    """One row per (lang, source) of ``values``: the metric's fences as columns
    ``<metric>_low`` and ``<metric>_high``."""
    metrics, at = list(FENCES), {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    own = stage(sketches(values, ["lang", "source"], metrics))
    fine = quantiles(own, ["lang", "source"], at)
    by_lang = quantiles(merged(own, ["lang"]), ["lang"], at)
    overall = quantiles(merged(own, []), [], at)
    name = lambda df, tag: df.select(*(F.col(c).alias(f"{tag}_{c}") for c in df.columns))
    found = fine.join(name(by_lang, "l"), (F.col("metric") == F.col("l_metric")) & F.col("lang").eqNullSafe(F.col("l_lang")))
    found = found.join(F.broadcast(name(overall, "a")), F.col("metric") == F.col("a_metric"))  # one row per metric
    pick = lambda q: F.when(F.col("total") >= LEAST, F.col(q)).when(F.col("l_total") >= LEAST, F.col(f"l_{q}")).otherwise(F.col(f"a_{q}"))
    found = found.select("lang", "source", "metric", *(pick(q).alias(q) for q in at))
    out = []
    for m, (below, above, least) in FENCES.items():
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
        low = F.col("q2") - below * spread if below else F.lit(None).cast("double")
        out += [F.max(F.when(F.col("metric") == m, low)).alias(f"{m}_low"), F.max(F.when(F.col("metric") == m, F.col("q2") + above * spread)).alias(f"{m}_high")]
    return found.groupBy("lang", "source").agg(*out)


def _failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def _shares(figures: DataFrame) -> DataFrame:
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return figures.withColumn("base_failed", _failed()).withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "word_length": share("word_chars", "n_words"),
        }
    )


def _verdicts(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` with their group's fences and column ``kept``."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    both = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    inside = F.lit(True)
    for m, (below, _, _) in FENCES.items():
        inside = inside & (F.col(m) <= F.col(f"{m}_high"))
        if below:
            inside = inside & (F.col(m) >= F.col(f"{m}_low"))
    return both.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(F.coalesce(inside, F.lit(False))))


def _rows_and_limits(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = stage(_shares(measures(docs.select("doc_id", "text", "lang", "source")).drop("text")))
    return rows, stage(thresholds(rows.filter(~F.col("base_failed"))))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept for rows (doc_id, text, lang, source).

    Null and empty texts have no words and fail the base rule.  Null languages
    and sources are groups like others.  Repeated rows count as often as they
    occur and are judged alike.  Values on a fence stay.  An empty table gives
    an empty result; further columns are ignored."""
    rows, limits = _rows_and_limits(docs)
    return _verdicts(rows, limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def filtered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns.  The
    figures are taken anew rather than moving the texts to meet them."""
    _, limits = _rows_and_limits(docs)
    whole = docs.select(F.struct("*").alias("_row"), "text", "lang", "source")
    return _verdicts(_shares(measures(whole)), limits).filter("kept").select("_row.*")
