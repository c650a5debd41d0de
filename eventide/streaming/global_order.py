"""Aggregates over the whole stream in arrival order, per micro-batch.

"Most active user so far" reads every record's running per-user count
(``processors.apply_rolling``, keyed, parallel) and keeps, across the whole
stream, the user with the highest count so far; equal counts go to the
later record.  A ``foreachBatch`` writer does the global part: within a
batch it is a running max over one global order (cut into slices by
``plans.ordered``), seeded with the previous batch's best, which is kept as
a one-row table per batch id in a shared folder.  Outputs and state are
written per batch id, so a replayed batch overwrites the same files.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.plans.ordered import running


def _committed(spark, path: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    ids = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("batch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            ids.append(int(name[len("batch="):]))
    return sorted(ids)


def most_active_writer(out_path: str, state_path: str, user: str, count_col: str,
                       order: list[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer adding ``top_user``/``top_count`` to each
    changelog row (``user``, ``count_col``, ``order`` columns)."""
    fields = [count_col, *order, user]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [b for b in _committed(spark, state_path) if b < batch_id]
        packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
        ranked = running(batch, [], order, {"_top": ("max", packed)})
        prev = None
        if earlier:
            prev = spark.read.parquet(os.path.join(state_path, f"batch={earlier[-1]}")).first()
            if prev is not None:
                seed = F.struct(*[F.lit(prev[f"f{i}"]).cast(batch.schema[c].dataType).alias(f"f{i}")
                                  for i, c in enumerate(fields)])
                ranked = ranked.withColumn("_top", F.greatest("_top", seed))
        ranked = ranked.withColumn("top_user", F.col(f"_top.f{len(fields) - 1}")) \
                       .withColumn("top_count", F.col("_top.f0"))
        ranked.drop("_top").write.mode("overwrite").parquet(os.path.join(out_path, f"batch={batch_id}"))
        best = batch.agg(F.max(packed).alias("t"))  # no second running pass
        if earlier and prev is not None:
            best = best.select(F.greatest("t", seed).alias("t"))
        best = best.select("t.*")
        best.where(F.col("f0").isNotNull()).coalesce(1).write.mode("overwrite") \
            .parquet(os.path.join(state_path, f"batch={batch_id}"))

    return write


def side_output_writer(route: str, main: Callable[[DataFrame, int], None],
                       side: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer sending rows where the boolean SQL expression
    ``route`` holds to ``side`` (e.g. time-outs) and the rest to ``main``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            side(batch.where(route), batch_id)
            main(batch.where(f"NOT ({route})"), batch_id)
        finally:
            batch.unpersist()
    return write
