"""Streaming forms of the windowed operators and the two-stream joins.

The window operators in ``eventide.operators.windows`` run unchanged on a
streaming DataFrame when given its watermarked event-time column; this
module adds what differs on streams: watermarking, the chained top-N
(``row_number`` is refused on streams) and the stream-stream joins with
the conditions Spark needs to evict join state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import interval_str, millis_to_ts
from eventide.operators.windows import count_per_window
from eventide.streaming.processors import apply_top_of_window

EVENT_TIME = "event_time"


def watermarked(df: DataFrame, ts_ms: str = "ts_ms", delay_ms: int = 0,
                out: str = EVENT_TIME) -> DataFrame:
    """Event time from an epoch-ms column plus a bounded-out-of-orderness
    watermark (``delay_ms`` = 0 for ascending timestamps)."""
    if out not in df.columns:
        df = df.withColumn(out, millis_to_ts(ts_ms))
    return df.withWatermark(out, interval_str(delay_ms))


def top_n_stream(df: DataFrame, time_col: str, item: str, size_ms: int, slide_ms: int, n: int,
                 count_col: str = "cnt", rank_col: str = "rank") -> DataFrame:
    """Top-N per window on a stream: count per (window, item); the n best of
    each window in each task; of those the n best of the window, the only
    ones held in state.  Runs in append mode: a window is emitted once the
    watermark closes it.  Ties go to the smaller item, null first."""
    counts = count_per_window(df, time_col, size_ms, slide_ms, [item], out=count_col, keep_window=True)
    bounds = [F.unix_millis("window.start").alias("window_start"), F.unix_millis("window.end").alias("window_end")]
    return apply_top_of_window(counts.select(*bounds, item, count_col), item, count_col, n, rank_col)


def window_join_stream(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                       size_ms: int) -> DataFrame:
    """Inner join within the same tumbling window.  Joining on the window
    of each side's watermarked event time lets Spark drop a window's state
    once the watermark passes its end."""
    size = interval_str(size_ms)
    # the window struct inherits the watermark; a stream may carry only one
    # event-time column, so the raw time column is dropped
    l = left.withColumn("_lw", F.window(left_time, size)).drop(left_time)
    r = right.withColumn("_rw", F.window(right_time, size)).drop(right_time)
    j = l.join(r, (l[key] == r[key]) & (F.col("_lw") == F.col("_rw")), "inner")
    return j.select(l[key].alias(key), F.unix_millis("_lw.start").alias("window_start"),
                    F.unix_millis("_lw.end").alias("window_end"),
                    *[c for c in j.columns if c not in (key, "_lw", "_rw")])


def interval_join_stream(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                         lower_ms: int, upper_ms: int, left_ms: str, right_ms: str) -> DataFrame:
    """Inner interval join on streams: the time range on the event-time
    columns bounds the join state; the time bucket in the key spreads a hot
    key over partitions as in the batch form."""
    width = max(upper_ms - lower_ms, 1)
    w = F.lit(width)
    l = left.withColumn("_b", F.explode(F.sequence(F.floor((F.col(left_ms) + lower_ms) / w),
                                                   F.floor((F.col(left_ms) + upper_ms) / w))))
    r = right.withColumn("_rb", F.floor(F.col(right_ms) / w))
    cond = ((l[key] == r[key]) & (F.col("_b") == F.col("_rb"))
            & (F.col(right_time) >= F.col(left_time) + F.expr(f"INTERVAL {lower_ms} MILLISECONDS"))
            & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {upper_ms} MILLISECONDS")))
    j = l.join(r, cond, "inner")
    return j.select(l[key].alias(key), *[c for c in j.columns if c not in (key, "_b", "_rb")])


def full_history_join_stream(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner equi-join of two streams with no time bound: both sides keep
    their whole history in state (the operator's definition)."""
    return left.join(right, on=[key], how="inner")


def reconcile_stream(app: DataFrame, third: DataFrame, id_col: str, app_time: str, third_time: str,
                     wait_ms: int) -> DataFrame:
    """Payment reconciliation as a stream-stream full outer join: a pair
    matches within ``wait_ms``; ids must not repeat on a side (``processors.
    apply_reconcile`` is the form for repeats); unmatched rows are emitted (as missing the
    other side) once the watermark passes ``time + wait``."""
    a = app.select(F.col(id_col).alias("_a_id"), F.col(app_time).alias("_a_t"), *[c for c in app.columns if c not in (id_col, app_time)])
    t = third.select(F.col(id_col).alias("_t_id"), F.col(third_time).alias("_t_t"), *[c for c in third.columns if c not in (id_col, third_time)])
    wait = F.expr(f"INTERVAL {wait_ms} MILLISECONDS")
    cond = ((F.col("_a_id") == F.col("_t_id"))
            & (F.col("_t_t") >= F.col("_a_t") - wait) & (F.col("_t_t") <= F.col("_a_t") + wait))
    j = a.join(t, cond, "full_outer")
    status = (F.when(F.col("_a_id").isNotNull() & F.col("_t_id").isNotNull(), F.lit("ok"))
              .when(F.col("_a_id").isNotNull(), F.lit("missing_third_party"))
              .otherwise(F.lit("missing_app")))
    return j.select(F.coalesce("_a_id", "_t_id").alias("pay_id"),
                    F.unix_millis("_a_t").alias("app_ts"), F.unix_millis("_t_t").alias("third_ts"),
                    status.alias("status"))
