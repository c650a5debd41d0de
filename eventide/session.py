"""Session helpers.

The library never creates a session on its own inside an operator: every
operator is a DataFrame -> DataFrame function.  ``get_session`` is for tests,
``bench.py`` and scripts; on a cluster the caller builds the session.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every session built here gets.  Time zone is pinned so that
# TIMESTAMP <-> epoch-ms conversions are reproducible; the operators
# themselves convert TIMESTAMP_NTZ without depending on it.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "eventide", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage;
    it is only read here, and without it an error is raised: a folder of one
    machine would lose data.  In local mode (one process, as in tests) a
    fresh scratch folder stands in for it.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"{CHECKPOINT_CONF} is unset: on {master!r} it must name a folder that all machines share")
        path = tempfile.mkdtemp(prefix="eventide-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for sink outputs, stream checkpoints and materialised intermediates,
    so that they live on storage every executor can reach.
    """
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "eventide", f"{name}-{uuid.uuid4().hex[:12]}")
