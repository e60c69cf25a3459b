"""The registered queries of the subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import (
    alignment,
    attribution,
    clusters,
    decontaminate,
    jaccard,
    language,
    neighbours,
    packing,
    pagetext,
    pieces,
    resample,
    tokenfiles,
    toxicity,
)
from lodestrata.llm.common import scratch, table

END_ID = 2
PACKED_END_ID = 1

Query = Callable[[SparkSession, str], DataFrame]


def piece_model() -> str:
    """Found where it is used: every machine has the file in a place of its own."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return attribution.sections(docs, byte_ranks, public_tokenizers.PATTERN)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.find_items(docs, items))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tokens")
    tokenfiles.write(table(spark, sf_dir, "documents"), folder, word_tokenizer, END_ID)
    return tokenfiles.read(spark, folder)


def op5_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.digests(docs, piece_model, keep=["doc_id"])


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return alignment.agreement(docs, byte_tokenizer, public_tokenizers.PATTERN, piece_model)


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer, PACKED_END_ID)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_attribution,
        op2_decontaminate,
        op3_toxicity,
        op4_token_files,
        op5_resample,
        op6_neighbours,
        op7_jaccard_join,
        op8_page_text,
        op9_pieces,
        op10_language_id,
        op11_token_alignment,
        op12_clusters,
        op13_packing,
    )
}
