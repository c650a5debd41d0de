"""Batch sources: parquet tables and literal rows.

``events`` is the click/login stream of the original jobs: ``user`` maps to
``user_id``, ``url``/event kind to ``event_type`` and the epoch-ms record
time to ``ts_ms`` (derived from the ``ts`` column).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import to_millis


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def with_millis(df: DataFrame, ts_col: str = "ts", out: str = "ts_ms") -> DataFrame:
    """Add epoch-ms ``out`` computed from timestamp column ``ts_col``."""
    dtype = df.schema[ts_col].dataType
    return df.withColumn(out, to_millis(ts_col, dtype))


def events(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The ``events`` table with an epoch-ms ``ts_ms`` column.

    ``columns`` limits what is read (column pruning reaches the scan either
    way; the explicit list keeps plans short).
    """
    df = read_table(spark, sf_dir, "events")
    df = with_millis(df)
    cols = columns or ["event_id", "user_id", "event_type", "value", "ts_ms"]
    return df.select(*cols)


def from_rows(spark: SparkSession, rows, schema: str, seq_col: str | None = "seq") -> DataFrame:
    """Bounded literal input (the ``fromElements`` source).

    Literal inputs have an arrival order that running aggregates depend on;
    ``seq_col`` records it as a column so the order survives distribution.
    """
    if seq_col:
        rows = [tuple(r) + (i,) for i, r in enumerate(rows)]
        schema = f"{schema}, {seq_col} bigint"
    return spark.createDataFrame(rows, schema)
