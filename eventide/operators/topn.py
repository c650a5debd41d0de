"""Top-N items per window.

Counts per ``(window, item)`` are aggregated first (partial aggregation), then
ranked per window: count descending, item ascending, ties broken
deterministically.  ``row_number() <= n`` becomes Spark's ``WindowGroupLimit``,
which keeps only n rows per window before and after the shuffle, so a window
with many items does not move them all.  Windows with fewer than n items
emit what they have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.windows import count_per_window


def top_n(counts: DataFrame, group: list[str], item: str, count: str, n: int,
          rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.col(count).desc(), F.col(item).asc())
    return counts.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def top_n_per_window(df: DataFrame, time_col: str, item: str, size_ms: int, slide_ms: int,
                     n: int, count_col: str = "cnt") -> DataFrame:
    """Sliding window count per item, then the n most frequent per window."""
    counts = count_per_window(df, time_col, size_ms, slide_ms, [item], out=count_col)
    return top_n(counts, ["window_start", "window_end"], item, count_col, n)


def top_n_all_items(df: DataFrame, time_col: str, item: str, size_ms: int, slide_ms: int,
                    n: int, count_col: str = "cnt") -> DataFrame:
    """The un-keyed ("all window") form: the same ranking computed from the
    item column alone (``map(_.url)`` first, so only that column is read).
    """
    slim = df.select(time_col, item)
    return top_n_per_window(slim, time_col, item, size_ms, slide_ms, n, count_col)
