"""Sinks: row-format text files, message payloads (Kafka), key-value upsert
(a Redis-style hash), JSON documents (a search index), JDBC inserts.

External services are not part of this library's runtime: for each one the
row-to-payload projection is a DataFrame function, and the writer is a
``foreachBatch``-compatible callable ``(batch_df, batch_id) -> None``.
Everything that lands on storage goes to a path under the shared
checkpoint folder (``eventide.session.shared_path``), never a local temp
folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# --- row-format text files -------------------------------------------------

def write_text(df: DataFrame, path: str, value_col: str = "value",
               max_records_per_file: int | None = None, mode: str = "overwrite") -> None:
    """Write one UTF-8 line per row (``value_col``) under ``path``."""
    w = df.select(F.col(value_col).cast("string").alias("value")).write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.text(path)


def text_stream_sink(df: DataFrame, path: str, checkpoint: str, roll_interval: str = "15 minutes",
                     max_records_per_file: int | None = None, value_col: str = "value"):
    """Streaming row-format file sink.  A new set of files is rolled per
    micro-batch (``roll_interval`` is the trigger) and by row count; there
    is no idle-time or byte-size roll in Spark's file sink."""
    w = (df.select(F.col(value_col).cast("string").alias("value")).writeStream
         .format("text").option("path", path).option("checkpointLocation", checkpoint)
         .trigger(processingTime=roll_interval))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w


# --- message queue ----------------------------------------------------------

def kafka_payload(df: DataFrame, value: str, topic: str, key: str | None = None) -> DataFrame:
    """Rows as Kafka records: ``topic, key, value`` (strings)."""
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), k.alias("key"),
                     F.col(value).cast("string").alias("value"))


def kafka_writer(bootstrap_servers: str, extra: dict | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer for ``kafka_payload`` rows.  Needs the Kafka
    connector on the classpath (not bundled with PySpark)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
        for k, v in (extra or {}).items():
            w = w.option(k, v)
        w.save()
    return write


# --- key-value hash (last write per key wins) -------------------------------

def hash_upsert_payload(df: DataFrame, key: str, fields: list[str], order: list[str]) -> DataFrame:
    """``HSET name key field``: after all writes, each key holds the fields of
    its latest row.  ``order`` is time first, then a unique tie-breaker; it
    stays in the payload, so a store can refuse what is older than it holds.
    Partial aggregation (``max_by``) before the shuffle."""
    record = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *fields])])
    return df.groupBy(key).agg(F.max_by(record, F.struct(*[F.col(o) for o in order])).alias("_r")).select(key, "_r.*")


def upsert_writer(write: Callable[[DataFrame, int], None], key: str, fields: list[str],
                  order: list[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that hands the latest row per key of each batch
    to ``write(payload, batch_id)``, the client of a key-value store."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(hash_upsert_payload(batch, key, fields, order), batch_id)
    return run


def parquet_store(path: str) -> Callable[[DataFrame, int], None]:
    """A store of payload files, a folder per batch id (a replay overwrites
    its own folder); ``latest`` reads the current rows."""
    def write(payload: DataFrame, batch_id: int) -> None:
        payload.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def latest(spark, path: str, key: str, fields: list[str], order: list[str]) -> DataFrame:
    """The latest row per key over all payloads of a ``parquet_store``."""
    return hash_upsert_payload(spark.read.parquet(path), key, fields, order)


# --- JSON documents ---------------------------------------------------------

def document_payload(df: DataFrame, key: str, value: str, out: str = "doc") -> DataFrame:
    """One JSON document per row: ``{"<key>": "<value>"}``."""
    return df.select(F.to_json(F.create_map(F.col(key).cast("string"),
                                            F.col(value).cast("string"))).alias(out))


def json_lines_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer appending documents as JSON lines, one folder
    per batch id (idempotent on replay)."""
    import os

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").text(os.path.join(path, f"batch={batch_id}"))
    return write


# --- JDBC -------------------------------------------------------------------

def jdbc_writer(url: str, table: str, properties: dict | None = None,
                columns: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer appending rows (``INSERT INTO table``) over JDBC.
    The driver jar for ``url`` must be on the classpath."""
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.select(*columns) if columns else batch
        b.write.jdbc(url=url, table=table, mode="append", properties=properties or {})
    return write


# --- print ------------------------------------------------------------------

def print_sink(df: DataFrame, label: str | None = None, checkpoint: str | None = None):
    """``print()`` / ``print(label)`` for a stream: the console sink, named by
    ``label`` (use the ``memory`` format with the same name in tests)."""
    w = df.writeStream.format("console").option("truncate", "false")
    if label:
        w = w.queryName(label)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w
