"""Corpus preparation: language, quality, near duplicates, packing.

Each stage works on all rows that its predecessor kept, which are written to the
shared folder and reread. Run as ``run(spark, sf_dir)`` over ``documents`` (and
``labels``, from which the quality rules learn).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow.llm import jaccard, language_id, packing, quality
from wardflow.llm.common import stage, table

TOKENIZER = "word_bpe_49k.json"


def accepted_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones have; the others go."""
    return language_id.keep_accepted(docs, language_id.train(docs.filter(~language_id.held_out())))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their five-word shingles."""
    return jaccard.keep_one_of_each(docs, n=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, placed in sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", accepted_languages),
    ("quality", good_documents),
    ("near_duplicates", without_near_duplicates),
    ("packing", packed),
]

ORACLE_SQL = None  # models, exact similarity joins and tokenizers have no SQL; tests hold the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
