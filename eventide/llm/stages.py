"""The pipeline's stages, each a call of one operator.

A stage gets the rows its predecessor kept; its decisions take effect in the
rows it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    from eventide.llm.quality import fit_quality, score_quality
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).where(F.col("predicted") == 1).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier passage."""
    from eventide.llm.line_dedup import dedup_lines
    return dedup_lines(docs, long_words=50)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    from eventide.llm.simhash import keep_one
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many whole copies of each document as the mix takes."""
    from eventide.llm.mixing import mixed_documents
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token sequences, packed."""
    from eventide.llm.packing import pack
    return pack(docs)
