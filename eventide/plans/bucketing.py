"""Range (interval) joins kept as equi-joins.

``left.t + lower <= right.t <= left.t + upper`` on an equality key alone
makes Spark compare every pair of a key in one task.  Cutting time into
buckets of width ``upper - lower`` turns it into an equi-join on
``(key, bucket)``: each right row falls in exactly one bucket, each left row
overlaps at most two, so every pair is produced once and a hot key spreads
over as many tasks as it has buckets.  The exact bound is applied after the
join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET = "_rj_bucket"


def bucketed_range_join(left: DataFrame, right: DataFrame, keys: list[str],
                        left_time: str, right_time: str, lower_ms: int, upper_ms: int,
                        bucket_ms: int | None = None) -> DataFrame:
    """Inner join on ``keys`` with ``left_time + lower_ms <= right_time <= left_time + upper_ms``.

    Column names other than ``keys`` must differ between the sides.
    """
    if upper_ms < lower_ms:
        raise ValueError("upper bound below lower bound")
    width = bucket_ms or max(upper_ms - lower_ms, 1)
    w = F.lit(width)
    lo = F.col(left_time) + F.lit(lower_ms)
    hi = F.col(left_time) + F.lit(upper_ms)
    l = left.withColumn(BUCKET, F.explode(F.sequence(F.floor(lo / w), F.floor(hi / w))))
    r = right.withColumn(BUCKET, F.floor(F.col(right_time) / w))
    j = l.join(r, on=list(keys) + [BUCKET], how="inner")
    return j.where(F.col(right_time).between(lo, hi)).drop(BUCKET)
