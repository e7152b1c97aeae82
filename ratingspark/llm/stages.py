"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without those the language models call toxic."""
    from ratingspark.llm.common import table
    from ratingspark.llm.toxicity import drop_toxic

    return drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    from ratingspark.llm.exact_dedup import drop_exact_copies

    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicate documents."""
    from ratingspark.llm.near_dedup import drop_near_copies

    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources get equal shares."""
    from ratingspark.llm.mixing import mix

    return mix(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    from ratingspark.llm.packing import pack
    from ratingspark.llm.queries import piece_digests

    return piece_digests(pack(docs))
