"""The corpus pipeline: operators of ``eventide.llm`` chained over documents.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import stages
from eventide.llm.common import documents, materialise

STAGES = [
    ("quality", stages.quality),
    ("line_dedup", stages.line_dedup),
    ("simhash", stages.simhash),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

#: The classifier, the fingerprints' hash and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
