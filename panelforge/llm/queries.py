"""Registered queries of the training-data operators: production parameters
over whole tables.  ``QUERIES`` maps a name to its builder, ``ORACLE`` a name
to DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import bpe, jaccard, lexical, lm, mixing, neighbours, oracles, pii, quality, substrings, suffixes, toxicity, urls, whitening
from panelforge.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), RULES)


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.linked(table(spark, sf_dir, "embeddings"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_pii": op2_pii,
    "op3_toxicity": op3_toxicity,
    "op4_substrings": op4_substrings,
    "op5_urls": op5_urls,
    "op6_suffixes": op6_suffixes,
    "op7_quality": op7_quality,
    "op8_jaccard": op8_jaccard,
    "op9_mixing": op9_mixing,
    "op10_neighbours": op10_neighbours,
    "op11_lexical": op11_lexical,
    "op12_whitening": op12_whitening,
    "op13_lm": op13_lm,
}

ORACLE: dict[str, str] = {
    "op4_substrings": oracles.SUBSTRINGS,
    "op7_quality": oracles.QUALITY,
    "op8_jaccard": oracles.JACCARD,
    "op10_neighbours": oracles.NEIGHBOURS,
    "op11_lexical": oracles.LEXICAL,
}
