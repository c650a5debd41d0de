"""Test helper: a table split into time-ordered files for file streams."""

import os

from pyspark.sql import functions as F

from eventide.sources.tables import with_millis


def split_by_time(spark, table_path, folder, n_files, ts_col="ts"):
    """Write ``table_path`` into ``folder`` as ``n_files`` time slices, one
    write per slice so that file modification times follow event time."""
    df = with_millis(spark.read.parquet(table_path), ts_col, "_ms")
    cuts = df.approxQuantile("_ms", [i / n_files for i in range(1, n_files)], 0.0)
    bounds = [None] + cuts + [None]
    os.makedirs(folder, exist_ok=True)
    for i in range(n_files):
        part = df
        if bounds[i] is not None:
            part = part.where(F.col("_ms") > bounds[i])
        if bounds[i + 1] is not None:
            part = part.where(F.col("_ms") <= bounds[i + 1])
        part.drop("_ms").coalesce(1).write.mode("append").parquet(folder)
    return spark.read.parquet(table_path).schema
