"""The registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm.common import documents
from eventide.sources.tables import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.toxicity import toxicity_query
    return toxicity_query(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


@query("op2_neighbours")
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from eventide.llm.ann import nearest
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.quality import quality_query
    return quality_query(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def _line_dedup_oracle() -> str:
    from eventide.llm.line_dedup import ORACLE
    return ORACLE


def _mixing_oracle() -> str:
    from eventide.llm.mixing import ORACLE
    return ORACLE


def _secrets_oracle() -> str:
    from eventide.llm.secrets_scan import oracle
    return oracle()


@query("op5_line_dedup", _line_dedup_oracle())
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.line_dedup import dedup_lines
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), report=True)


@query("op10_mixing", _mixing_oracle())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.mixing import mixing_query
    return mixing_query(documents(spark, sf_dir))


@query("op3_secrets", _secrets_oracle())
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.secrets_scan import secrets_query
    return secrets_query(documents(spark, sf_dir))


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.sharding import sharding_query
    return sharding_query(documents(spark, sf_dir))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.simhash import simhash_query
    return simhash_query(documents(spark, sf_dir))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.packing import pack
    return pack(documents(spark, sf_dir))


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.fingerprints import fingerprint_documents
    return fingerprint_documents(documents(spark, sf_dir))


def _audit_oracle() -> str:
    from eventide.llm.filter_audit import ORACLE
    return ORACLE


@query("op11_filter_audit", _audit_oracle())
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.filter_audit import audit_query
    return audit_query(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.token_alignment import alignment_query
    return alignment_query(documents(spark, sf_dir))


def _license_oracle() -> str:
    from eventide.llm.license_scan import oracle
    return oracle()


@query("op13_licenses", _license_oracle())
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventide.llm.license_scan import licenses
    return licenses(documents(spark, sf_dir))
