"""Streaming sources.

The original jobs draw from endless generator sources.  Here a stream is
read from files (``readStream`` over a folder of parquet or text files), so
the same tables drive batch and streaming runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventide.functions.time import millis_to_ts, to_millis

EVENT_TIME = "event_time"

def event_stream(spark: SparkSession, folder: str, schema: StructType | str,
                 ts_col: str = "ts", max_files_per_trigger: int | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Unbounded stream over the files of ``folder``.

    Adds ``ts_ms`` (epoch ms, if ``ts_col`` is a timestamp) and the
    event-time column ``event_time`` (TIMESTAMP, what ``withWatermark``
    accepts; ``TIMESTAMP_NTZ`` is refused there).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(folder)
    dtype = df.schema[ts_col].dataType
    if dtype.typeName() in ("long", "integer"):
        df = df.withColumn("ts_ms", F.col(ts_col).cast("bigint"))
    else:
        df = df.withColumn("ts_ms", to_millis(ts_col, dtype))
    return df.withColumn(EVENT_TIME, millis_to_ts("ts_ms"))


def text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """One string per line (column ``value``), bounded or as a file stream."""
    if streaming:
        return spark.readStream.format("text").load(path)
    return spark.read.text(path)
