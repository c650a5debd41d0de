"""Two-input operators: window join, interval join, full-history join and
payment reconciliation.

Both inputs must use distinct column names apart from the join key; the
functions that take a ``left_prefix``/``right_prefix`` rename for you.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import tumble_start
from eventide.plans.bucketing import bucketed_range_join
from eventide.plans.ordered import running


def prefixed(df: DataFrame, prefix: str, keep: list[str] = ()) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])


ROWS_PER_SALT = 100_000
HEAVY_KEYS = 10_000


def heavy_keys(left: DataFrame, right: DataFrame, on: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(*on, _a, _b): how many blocks the left and the right rows of a key are
    cut into, for keys with more than ``rows_per_salt`` rows on a side.

    At most the ``HEAVY_KEYS`` heaviest, so the table may be broadcast; any
    other key holds less than a 1 / HEAVY_KEYS share of the rows.
    """
    side = lambda df, l, r: df.select(*on, F.lit(l).alias("_l"), F.lit(r).alias("_r"))
    sizes = (side(left, 1, 0).unionByName(side(right, 0, 1)).groupBy(*on)
             .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
             .where((F.col("_l") > 0) & (F.col("_r") > 0) & (F.greatest("_l", "_r") > rows_per_salt)))
    blocks = lambda c: F.ceil(F.col(c) / F.lit(rows_per_salt)).cast("int")
    return (sizes.orderBy(F.greatest("_l", "_r").desc(), *on).limit(HEAVY_KEYS)
            .select(*on, blocks("_l").alias("_a"), blocks("_r").alias("_b")))


def salted_join(left: DataFrame, right: DataFrame, on: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Inner equi-join in which a heavy key is a grid of blocks.

    The left rows of such a key are dealt over ``_a`` blocks by a hash and its
    right rows over ``_b``; every pair of a left and a right block is a cell
    and a join key by itself, so no cell holds more than about
    ``rows_per_salt`` rows of a side and neither side of a hot key stays whole.
    Block counts are attached by a broadcast of the bounded ``heavy_keys``,
    before any row is shuffled; the rows of all other keys have one cell and
    are not copied.
    """
    heavy = heavy_keys(left, right, on, rows_per_salt)
    names = [f"_h{i}" for i in range(len(on))]
    table = F.broadcast(heavy.toDF(*names, "_a", "_b"))

    def celled(df: DataFrame, own: str, own_cell: str, other: str, other_cell: str) -> DataFrame:
        known = df.join(table, [F.col(k) == F.col(n) for k, n in zip(on, names)], "left")
        deal = F.when(F.col(own).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*df.columns), F.col(own)).cast("int"))
        copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return known.withColumn(own_cell, deal).withColumn(other_cell, F.explode(copies)).drop(*names, "_a", "_b")

    l, r = celled(left, "_a", "_salt_l", "_b", "_salt_r"), celled(right, "_b", "_salt_r", "_a", "_salt_l")
    return l.join(r, [*on, "_salt_l", "_salt_r"]).drop("_salt_l", "_salt_r")


def window_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                size_ms: int, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Inner join of rows with equal ``key`` in the same tumbling window.

    The window start is part of the equi-join key, so a hot key is spread
    over its windows; a hot (key, window) is a grid of blocks.
    """
    l = left.withColumn("window_start", tumble_start(left_time, size_ms))
    r = right.withColumn("window_start", tumble_start(right_time, size_ms))
    j = salted_join(l, r, [key, "window_start"], rows_per_salt)
    return j.withColumn("window_end", F.col("window_start") + F.lit(size_ms))


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                  lower_ms: int, upper_ms: int) -> DataFrame:
    """Inner join with ``left_time + lower <= right_time <= left_time + upper``
    (both ends inclusive), via time buckets (see ``plans.bucketing``)."""
    return bucketed_range_join(left, right, [key], left_time, right_time, lower_ms, upper_ms)


def full_history_join(left: DataFrame, right: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Every left row with every right row of the same key, whatever their times.

    This is the operator's definition (each side keeps its whole history),
    so the output size is the sum of per-key products; the work of a hot key
    is spread over a grid of blocks of both sides.
    """
    return salted_join(left, right, [key], rows_per_salt)


STATUS_OK = "ok"
STATUS_MISSING_THIRD = "missing_third_party"
STATUS_MISSING_APP = "missing_app"


HEAVY_ID_ROWS = 100_000


def quiet_segments(events: DataFrame, wait_ms: int) -> DataFrame:
    """``events`` (pay_id, ts, side) with ``segment``: the time at which the
    id's events begin anew after a gap of more than ``wait_ms``.

    Behind such a gap all timers have fired and nothing is pending, so a
    segment is a scan by itself.  The event before and the segment's start are
    running maxima in slices of the order, so a hot id is in no single task.
    """
    like, order = events.select("ts"), ["ts", "side"]
    before = running(events, ["pay_id"], order, {"before": ("max", F.col("ts"))}, include_current=False, like=like)
    opens = F.col("before").isNull() | (F.col("ts") - F.col("before") > wait_ms)
    return (running(before.withColumn("opened", F.when(opens, F.col("ts"))), ["pay_id"], order,
                    {"segment": ("max", F.col("opened"))}, like=like).select("pay_id", "ts", "side", "segment"))


def reconcile(app: DataFrame, third: DataFrame, id_col: str, app_time: str, third_time: str,
              wait_ms: int = 5000, heavy_rows: int = HEAVY_ID_ROWS) -> DataFrame:
    """Match each payment id across the two inputs, waiting ``wait_ms``.

    One event is pending per id at a time.  An event consumes a pending event
    of the other side (ok), or becomes the pending one of its side, replacing
    an earlier one, and arms a timer ``wait_ms`` later.  A timer that fires
    before the next event of the id reports what is then pending as missing
    its counterpart; timers are not cancelled.  At the end all timers fire.
    Ids whose events do not repeat thus match when ``|t_app - t_third| <=
    wait_ms`` and are reported on both sides otherwise.

    Events are hash-partitioned by (id, segment) and sorted; the scan keeps one
    pending event and the armed timers.  The ids with more than ``heavy_rows``
    events (the ``HEAVY_KEYS`` heaviest; any other holds less than that share
    of the events) are cut into ``quiet_segments``; an id without a gap longer
    than ``wait_ms`` is one segment.  Null ids match nothing.  Output: ``pay_id, app_ts, third_ts, status``.
    """
    wait, kind = int(wait_ms), app.schema[id_col].dataType.simpleString()
    side = lambda df, t, n: df.select(F.col(id_col).alias("pay_id"), F.col(t).cast("bigint").alias("ts"), F.lit(n).alias("side"))
    events = side(app, app_time, 0).unionByName(side(third, third_time, 1))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, segment, pending, timers, out = None, None, None, [], []

        def report():
            if pending is not None:
                t, s = pending
                out.append((key, t, None, STATUS_MISSING_THIRD) if s == 0 else (key, None, t, STATUS_MISSING_APP))

        for pdf in batches:
            for k, g, t, s in zip(*(pdf[c].tolist() for c in ("pay_id", "segment", "ts", "side"))):
                if k != key or g != segment:
                    report()
                    key, segment, pending, timers = k, g, None, []
                if timers and timers[0] < t:
                    report()
                    pending, timers = None, [x for x in timers if x >= t]
                if pending is not None and pending[1] != s:
                    out.append((k, *((t, pending[0]) if s == 0 else (pending[0], t)), STATUS_OK))
                    pending = None
                else:
                    pending = (t, s)
                    timers.append(t + wait)  # times do not fall, so neither do timers
            yield _reconciled(out)
            out = []
        report()
        yield _reconciled(out)

    own = events.where(F.col("pay_id").isNotNull())
    heavy = (own.groupBy("pay_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy_rows)
             .orderBy(F.desc("n"), "pay_id").limit(HEAVY_KEYS).select(F.col("pay_id").alias("heavy_id")).collect())
    cut = own.withColumn("segment", F.lit(0).cast("bigint"))
    if heavy:
        table = F.broadcast(app.sparkSession.createDataFrame(heavy, f"heavy_id {kind}"))     # HEAVY_KEYS rows at most
        same = F.col("pay_id") == F.col("heavy_id")
        cut = cut.join(table, same, "left_anti").unionByName(quiet_segments(own.join(table, same, "left_semi"), wait))
    known = (cut.repartition("pay_id", "segment").sortWithinPartitions("pay_id", "segment", "ts", "side")
             .mapInPandas(scan, f"pay_id {kind}, app_ts bigint, third_ts bigint, status string"))
    alone = events.where(F.col("pay_id").isNull()).select(
        "pay_id", F.when(F.col("side") == 0, F.col("ts")).alias("app_ts"), F.when(F.col("side") == 1, F.col("ts")).alias("third_ts"),
        F.when(F.col("side") == 0, F.lit(STATUS_MISSING_THIRD)).otherwise(F.lit(STATUS_MISSING_APP)).alias("status"))
    return known.unionByName(alone)


def _reconciled(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["pay_id", "app_ts", "third_ts", "status"]).astype({"app_ts": "Int64", "third_ts": "Int64"})
