"""The corpus pipeline: its stages in order, each on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from tillroll.llm import bpe, exact_dedup, jaccard_join, mixing, ppm_language
from tillroll.llm.common import give_back, read_table, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a predictable language go: null texts and texts without a letter."""
    model = ppm_language.train(docs)
    if not model.languages:  # no labels to learn from: the text alone decides
        return docs.filter(docs["text"].rlike(ppm_language.LETTER))
    predicted = ppm_language.predict(docs, model)
    del model  # the tasks have their own copy
    give_back()
    return predicted.filter(predicted["lang_pred"] != ppm_language.UNKNOWN).select("whole.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts the row with the smallest id stays."""
    return exact_dedup.keep_first_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents linked by shingle similarity the one with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def weighted_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: left out, once, or repeated."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with the digests of the ids and of the decoded text."""
    encoded = bpe.encode(docs, public_tokenizers.path(bpe.VOCABULARY), carry=["doc_id", "source", "lang"])
    return encoded.select("whole.*", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("mixing", weighted_mix),
    ("bpe", tokens),
]

#: Language prediction, the word budget and tokenizing have no SQL; the tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on `documents`; every stage is written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
