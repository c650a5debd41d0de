"""Event-time windows: tumbling and sliding, keyed or global.

Windows are epoch-aligned and half-open ``[start, end)``, as in Spark's
``window``.  Aggregation is incremental (partial aggregate before the
shuffle), including the global windows, so no window is ever gathered in
one place.  Bounds come out as epoch-ms ``bigint`` (``window_start``,
``window_end``).

``time_col`` is either an epoch-ms ``bigint`` (batch) or the watermarked
``TIMESTAMP`` column of a stream.  The same functions run on streaming
DataFrames.  Exact distinct counts are two chained aggregations (per
window and value, then per window), which works in batch and in streaming
append mode and keeps every stage partially aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from eventide.functions.time import interval_str, window_bounds_ms
from eventide.plans.ordered import running


def event_time(df: DataFrame, time_col: str) -> Column:
    if isinstance(df.schema[time_col].dataType, NumericType):
        return F.timestamp_millis(F.col(time_col))
    return F.col(time_col)


def window_col(df: DataFrame, time_col: str, size_ms: int, slide_ms: int | None = None) -> Column:
    et = event_time(df, time_col)
    if slide_ms is None or slide_ms == size_ms:
        return F.window(et, interval_str(size_ms))
    return F.window(et, interval_str(size_ms), interval_str(slide_ms))


def window_agg(df: DataFrame, time_col: str, size_ms: int, slide_ms: int | None,
               keys: list[str], aggs: list[Column], keep_window: bool = False) -> DataFrame:
    """``groupBy(window, *keys).agg(*aggs)`` with window bounds in ms.

    ``keep_window=True`` keeps the ``window`` struct (needed to chain a
    second streaming aggregation on it).
    """
    g = df.groupBy(window_col(df, time_col, size_ms, slide_ms).alias("window"), *keys).agg(*aggs)
    extra = ["window"] if keep_window else []
    return g.select(*window_bounds_ms("window"), *keys,
                    *[c for c in g.columns if c not in ("window", *keys)], *extra)


def _paned(df: DataFrame, time_col: str, size_ms: int, slide_ms: int | None) -> bool:
    """Whether sliding windows can be put together from whole panes."""
    return (slide_ms is not None and slide_ms != size_ms and size_ms % slide_ms == 0 and not df.isStreaming
            and isinstance(df.schema[time_col].dataType, NumericType))


def _pane(time_col: str, slide_ms: int) -> Column:
    return (F.col(time_col) - F.pmod(F.col(time_col), F.lit(slide_ms))).cast("bigint")


def _window_starts(pane: str, size_ms: int, slide_ms: int) -> Column:
    """Starts of the windows that hold a pane, one row for each."""
    return F.explode(F.sequence(F.col(pane) - F.lit(size_ms - slide_ms), F.col(pane), F.lit(slide_ms)))


def accumulate(df: DataFrame, time_col: str, size_ms: int, slide_ms: int | None, keys: list[str],
               accumulators: dict[str, tuple[str, Column]], result: dict[str, Column]) -> DataFrame:
    """A user-defined aggregate per window: own accumulators, merged, then a result.

    ``accumulators`` maps names to ``(kind, column)``, kind being one of sum,
    count, min, max (a struct's min or max gives min_by / max_by); these merge,
    so they are partial before the shuffle and, in batch, per pane of a
    sliding window.  ``result`` maps output names to columns over the merged
    accumulators.  A reduce is one accumulator and itself as result.
    """
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    merge = first | {"count": F.sum}
    if _paned(df, time_col, size_ms, slide_ms):
        panes = df.where(F.col(time_col).isNotNull()).groupBy(_pane(time_col, slide_ms).alias("_pane"), *keys) \
            .agg(*[first[k](c).alias(n) for n, (k, c) in accumulators.items()])
        g = (panes.withColumn("window_start", _window_starts("_pane", size_ms, slide_ms))
             .groupBy("window_start", *keys).agg(*[merge[k](n).alias(n) for n, (k, _) in accumulators.items()])
             .withColumn("window_end", F.col("window_start") + F.lit(size_ms)))
    else:
        g = window_agg(df, time_col, size_ms, slide_ms, keys, [first[k](c).alias(n) for n, (k, c) in accumulators.items()])
    return g.select("window_start", "window_end", *keys, *[c.alias(n) for n, c in result.items()])


def count_per_window(df: DataFrame, time_col: str, size_ms: int, slide_ms: int | None = None,
                     keys: list[str] = (), out: str = "cnt", keep_window: bool = False) -> DataFrame:
    """Tumbling/sliding count per key (``map(k -> 1)`` + ``reduce(+)``).

    A batch's sliding windows are added up from counts per pane, so rows are
    not multiplied before the first aggregation."""
    if _paned(df, time_col, size_ms, slide_ms) and not keep_window:
        return accumulate(df, time_col, size_ms, slide_ms, list(keys), {out: ("count", F.lit(1))}, {out: F.col(out)})
    return window_agg(df, time_col, size_ms, slide_ms, list(keys),
                      [F.count(F.lit(1)).alias(out)], keep_window)


def distinct_per_window(df: DataFrame, time_col: str, size_ms: int, distinct_col: str,
                        slide_ms: int | None = None, keys: list[str] = (),
                        out: str = "uv", approx: bool = False) -> DataFrame:
    """Number of distinct ``distinct_col`` values per window."""
    if approx:
        return window_agg(df, time_col, size_ms, slide_ms, list(keys),
                          [F.approx_count_distinct(distinct_col).cast("bigint").alias(out)])
    if _paned(df, time_col, size_ms, slide_ms):
        g = _paned_distinct(df, time_col, size_ms, slide_ms, distinct_col, list(keys), nulls=True)
        return g.select("window_start", "window_end", *keys, F.col("uv").alias(out))
    per = _per_value(df, time_col, size_ms, slide_ms, list(keys), distinct_col)
    g = per.groupBy("window", *keys).agg(F.count(F.lit(1)).alias(out))
    return g.select(*window_bounds_ms("window"), *keys, out)


def _per_value(df: DataFrame, time_col: str, size_ms: int, slide_ms: int | None,
               keys: list[str], value_col: str) -> DataFrame:
    """First stage of an exact distinct count: one row per (window, keys,
    value) with its row count.  Both stages aggregate partially before
    their shuffle, and on a stream they chain in append mode."""
    return (df.groupBy(window_col(df, time_col, size_ms, slide_ms).alias("window"), *keys, value_col)
            .agg(F.count(F.lit(1)).alias("_rows")))


def _paned_distinct(df: DataFrame, time_col: str, size_ms: int, slide_ms: int, value_col: str, keys: list[str],
                    nulls: bool = False) -> DataFrame:
    """``window_start, window_end, *keys, pv, uv``: rows and exact distinct
    values (a null counts as one only with ``nulls``) of every sliding window.

    Nothing is copied to its windows.  A value's pane covers the windows that
    begin from ``size - slide`` before the pane up to the pane; those that the
    value's previous pane covers already are left out, so each (window, value)
    is covered once.  What is left is an interval of windows: +1 where it
    begins, -1 behind its end.  A running sum over the window starts (in
    slices of the order) turns the ends into counts; rows are counted by the
    same ends, all of them added up per start first.
    """
    reach = size_ms - slide_ms
    panes = (df.where(F.col(time_col).isNotNull()).groupBy(*keys, F.col(value_col).alias("_value"), _pane(time_col, slide_ms).alias("_pane"))
             .agg(F.count(F.lit(1)).alias("_rows")))
    by_value = running(panes, [*keys, "_value"], ["_pane"], {"_earlier": ("max", F.col("_pane"))}, include_current=False,
                       like=df.select(_pane(time_col, slide_ms).alias("_pane")))
    begins = F.greatest(F.col("_pane") - F.lit(reach), F.coalesce(F.col("_earlier") + F.lit(slide_ms), F.col("_pane") - F.lit(reach)))
    counted = F.lit(1) if nulls else F.col("_value").isNotNull().cast("int")
    end = lambda at, rows, uv: F.struct(at.cast("bigint").alias("window_start"), rows.cast("bigint").alias("pv"), uv.cast("bigint").alias("uv"))
    past = F.col("_pane") + F.lit(slide_ms)
    ends = (by_value.select(*keys, F.explode(F.array(
                end(F.col("_pane") - F.lit(reach), F.col("_rows"), F.lit(0)), end(begins, F.lit(0), counted),
                end(past, -F.col("_rows"), -counted))).alias("e"))
            .select(*keys, "e.*").groupBy(*keys, "window_start").agg(F.sum("pv").alias("_pv"), F.sum("uv").alias("_uv")))
    # the windows themselves: of panes, of which there are few, not of rows or values
    starts = (df.where(F.col(time_col).isNotNull()).select(*keys, _pane(time_col, slide_ms).alias("_pane")).distinct()
              .select(*keys, _window_starts("_pane", size_ms, slide_ms).alias("window_start")).distinct())
    marks = (ends.unionByName(starts.select(*keys, "window_start", F.lit(0).cast("bigint").alias("_pv"), F.lit(0).cast("bigint").alias("_uv")))
             .groupBy(*keys, "window_start").agg(F.sum("_pv").alias("_pv"), F.sum("_uv").alias("_uv")))
    sums = running(marks, keys, ["window_start"], {"pv": ("sum", F.col("_pv")), "uv": ("sum", F.col("_uv"))},
                   like=df.select(_pane(time_col, slide_ms).alias("window_start")))
    return (sums.where(F.col("pv") > 0).withColumn("window_end", F.col("window_start") + F.lit(size_ms))
            .select("window_start", "window_end", *keys, "pv", "uv"))


def pv_per_uv(df: DataFrame, time_col: str, size_ms: int, slide_ms: int, user_col: str,
              out: str = "pv_per_uv", approx: bool = False) -> DataFrame:
    """Global sliding window: page views divided by distinct users (double)."""
    if approx:
        g = window_agg(df, time_col, size_ms, slide_ms, [],
                       [F.count(F.lit(1)).alias("pv"),
                        F.approx_count_distinct(user_col).cast("bigint").alias("uv")])
    elif _paned(df, time_col, size_ms, slide_ms):
        g = _paned_distinct(df, time_col, size_ms, slide_ms, user_col, [])
    else:
        per = _per_value(df, time_col, size_ms, slide_ms, [], user_col)
        g = (per.groupBy("window").agg(F.sum("_rows").alias("pv"), F.count(F.lit(1)).alias("uv"))
             .select(*window_bounds_ms("window"), "pv", "uv"))
    return g.select("window_start", "window_end", "pv", "uv",
                    (F.col("pv").cast("double") / F.col("uv")).alias(out))


def process_window(df: DataFrame, time_col: str, size_ms: int, slide_ms: int | None, keys: list[str],
                   fn, schema: str) -> DataFrame:
    """Arbitrary user code over all rows of a (window, keys) group — the
    full-window process function.  ``fn(pdf)`` gets the group as a pandas
    DataFrame with ``window_start``/``window_end`` (epoch ms) and returns a
    pandas DataFrame matching ``schema``.

    This buffers a whole group in one Python worker, like the full-window
    function it mirrors; prefer ``window_agg`` with built-in (incremental)
    aggregates whenever the computation is expressible that way.
    """
    tagged = (df.withColumn("window", window_col(df, time_col, size_ms, slide_ms))
              .withColumn("window_start", F.unix_millis("window.start"))
              .withColumn("window_end", F.unix_millis("window.end"))
              .drop("window"))
    return tagged.groupBy("window_start", "window_end", *keys).applyInPandas(fn, schema=schema)
