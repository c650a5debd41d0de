"""Helpers shared by the corpus operators.

``materialise`` cuts a lineage by writing Parquet to the cluster's shared
folder (``spark.checkpoint.dir``); it never keeps a single local copy.
``ranked`` numbers rows and sums a column along a total order without
collecting a group in one task.  The byte helpers work on the UTF-8 buffers
of Arrow string columns inside tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.session import shared_path
from eventide.sources.tables import read_table

#: Characters that part words: space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
HELD_OUT_REMAINDER = 2


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The files survive lost executors, and each later use reads them instead
    of computing ``df`` again.
    """
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = 1_000
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``BATCH_ROWS`` rows and
    ``BATCH_BYTES`` (a longer text is a batch by itself): 10,000 texts at once,
    or a thousand of 1 MB, would take a worker's memory.

    These are settings of the session: Spark reads them when a job runs, which
    for a returned frame is later, so they stay.
    """
    conf, rows, size = df.sparkSession.conf, *(f"spark.sql.execution.arrow.{x}" for x in ("maxRecordsPerBatch", "maxBytesPerBatch"))
    if not 0 < int(conf.get(rows)) <= BATCH_ROWS:
        conf.set(rows, str(BATCH_ROWS))
    if df.sparkSession._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > BATCH_BYTES:
        conf.set(size, str(BATCH_BYTES))
    return df


def frugal(fn):
    """``fn`` over Arrow batches, giving freed memory back to the machine.

    A Python worker stays when its task ends, and the allocators keep what
    they once took; beside a JVM at its full heap that adds up.
    """
    def run(batches):
        try:
            for out in fn(batches):
                yield out
                give_back_memory()
        finally:
            give_back_memory()
    return run


def give_back_memory() -> None:
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(read_table(spark, sf_dir, "documents"))


def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == HELD_OUT_REMAINDER,
                      F.lit(False))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet (clash-free helpers)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, text: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled training texts: (doc_id, text, label).

    Rows come from ``labels`` outside the held-out quarter.  The bound is
    exact and the choice is by a hash of the id, so it does not depend on how
    the tables are laid out; being bounded, the sample may be broadcast.
    A label that is null, and a repeated id with two different labels, is
    left out; of the rows that repeat an id the smallest text counts.
    """
    lab = (labels.where(~held_out(F.col("doc_id")) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("y2"))
           .where("y = y2").select("doc_id", F.col("y").cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return (docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
            .join(F.broadcast(lab), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")))


def ranked(df: DataFrame, group: list[str], order: list[Column], bucket: Column, rank: str,
           value: str | None = None, total: str | None = None) -> DataFrame:
    """Number rows from 0 within ``group`` along (bucket, order).

    ``bucket`` is a non-negative integer that cuts every group into parts of
    a bounded size and sorts before ``order``.  Only (group, bucket) pairs
    meet in one task; the parts' starts are sums over one row per part.  With
    ``value``, ``total`` is the sum of the values of all earlier rows.
    """
    b, n0, s0 = fresh(df, "bucket", "part_rows", "part_sum")
    keyed = df.withColumn(b, bucket)
    keys = [*group, b]
    right = [f"_part_{i}" for i in range(len(keys))]
    ahead = Window.partitionBy(*right[:-1]).orderBy(right[-1]).rowsBetween(Window.unboundedPreceding, -1)
    start = lambda c, out: F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(out)
    parts = (keyed.groupBy(*[F.col(k).alias(r) for k, r in zip(keys, right)])
             .agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(value) if value else F.lit(0), F.lit(0)).alias("_s"))
             .select(*right, start("_n", n0), start("_s", s0)))
    same = [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, right)]
    joined = keyed.join(parts, same, "left").drop(*right)
    w = Window.partitionBy(*keys).orderBy(*order)
    out = joined.withColumn(rank, F.row_number().over(w) - 1 + F.col(n0))
    if value:
        before = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
        out = out.withColumn(total, F.coalesce(before, F.lit(0)) + F.col(s0))
    return out.drop(b, n0, s0)


# --- UTF-8 buffers inside tasks ----------------------------------------------

def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of an Arrow string column (nulls are empty)."""
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int):
    """Runs ``(i, j)`` of whole rows holding about ``limit`` bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def segments(raw: np.ndarray, offsets: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of pieces of at most about ``limit`` bytes and each one's row.

    Rows stay whole unless they are longer; those are cut before a space or
    line end (or, in a run without any, not at all).
    """
    if not len(offsets) or (np.diff(offsets) <= limit).all():
        return offsets, np.arange(len(offsets) - 1)
    starts, rows = [], []
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        starts.append(a)
        rows.append(row)
        while b - a > limit:
            space = np.flatnonzero((raw[a + limit:b] == 32) | (raw[a + limit:b] == 10))[:1] if b - a < 8 * limit else \
                np.flatnonzero((raw[a + limit:a + 8 * limit] == 32) | (raw[a + limit:a + 8 * limit] == 10))[:1]
            if not len(space):
                break
            a = a + limit + int(space[0])
            starts.append(a)
            rows.append(row)
    return np.array([*starts, int(offsets[-1])]), np.array(rows)


_PRIME = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the prime and of its inverse modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
        for key, base in (("up", _PRIME), ("down", inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span ``raw[start:end]``, all at once.

    A polynomial over the bytes modulo 2**64 from one cumulative sum, then
    mixed with the length; equal spans hash alike wherever they stand.
    """
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))
