"""A corpus pipeline: five stages over ``documents``, each on what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as a
table in the shared folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import decontaminate, jaccard, language, pieces, toxicity
from lodestrata.llm.common import made, release, stored, table
from lodestrata.llm.queries import piece_model

#: Four stages are learned or searched by programs that SQL does not express.
ORACLE_SQL = None


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that are predicted toxic; learned from the labels of ``docs``."""
    return toxicity.civil_documents(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose language is ``und``."""
    return language.known_language(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of copies and near copies."""
    return jaccard.one_of_each(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, their number, and digests of the ids
    and of the decoded text."""
    return pieces.digests(docs, piece_model, keep=["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("toxicity", civil),
    ("language_id", known_language),
    ("jaccard_join", distinct),
    ("decontaminate", clean_of_benchmark),
    ("pieces", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = made()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        # What the stage and those before it wrote on the way is not needed any more.
        release(spark, before, [docs])
    return docs
