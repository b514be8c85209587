"""Corpus pipeline: documents in, token ids of clean, distinct documents out.

Each stage takes the documents that its predecessor kept and returns those that
it keeps, with the columns of documents; the last one returns their encodings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import bpe, decontaminate, partenum, resample, surrogates
from loomline.llm.shared import staged, table

#: Near duplicates: five-word shingles, similarity of 0.8 or more.
SHINGLE, SIMILARITY = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects."""
    return resample.resample(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones."""
    return partenum.one_of_each_class(docs, SHINGLE, SIMILARITY)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), passages=True)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data, and the length that they then have."""
    new = surrogates.replace_entities(docs)
    return new.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else new[c] for c in docs.columns))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of every document."""
    return bpe.encode(docs, bpe.default_vocabulary(), with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", personal_data),
    ("bpe", encoding),
]

#: The stages cannot be put in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
