"""Rolling (per-record) aggregates on a keyed stream.

A keyed rolling aggregate emits, for every input record, the aggregate of
all records of its key up to and including it.  In batch this is a running
window; ``eventide.plans.ordered.running`` computes it in slices of the
order, so a dominant key does not serialise the job.  ``order`` must be a
total order per key (time first, then a unique id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.plans.ordered import running

KINDS = ("sum", "max", "min", "count")


def rolling(df: DataFrame, key: str | list[str], order: list[str], value: str | None,
            kind: str, out: str) -> DataFrame:
    """``keyBy(key).sum/max/min(value)`` or a running ``count``."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    keys = [key] if isinstance(key, str) else list(key)
    expr = F.lit(1) if kind == "count" else F.col(value)
    return running(df, keys, order, {out: (kind, expr)})


def rolling_extreme_by(df: DataFrame, key: str | list[str], order: list[str], value: str,
                       record: list[str], kind: str = "max", prefix: str = "best_") -> DataFrame:
    """Running ``maxBy``/``minBy``: the whole record holding the largest
    (smallest) ``value`` so far; on ties the first record wins, null values
    never do.  Value and order may be of any comparable type.

    Emitted as ``prefix + field`` columns for every field in ``record``.
    """
    if kind not in ("max", "min"):
        raise ValueError("kind must be 'max' or 'min'")
    keys = [key] if isinstance(key, str) else list(key)
    packed = F.struct(*[F.col(c).alias(c) for c in record])
    out = running(df, keys, order, {"_best": (f"{kind}_by", F.col(value), packed)})
    return out.select(*df.columns, *[F.col(f"_best.{c}").alias(prefix + c) for c in record])


def most_active_so_far(df: DataFrame, user: str, order: list[str],
                       count_col: str = "user_count", top_user: str = "top_user",
                       top_count: str = "top_count") -> DataFrame:
    """Per record: the running count of its user, then over the whole stream
    (one global order) the user with the highest running count so far; on
    equal counts the later record wins.

    Both scans run in slices of the order, so neither runs in a single task.
    """
    counted = running(df, [user], order, {count_col: ("count", F.lit(1))})
    packed = F.struct(F.col(count_col).alias("_c"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                      F.col(user).alias("_u"))
    best = running(counted, [], order, {"_top": ("max", packed)})
    return best.select(*counted.columns, F.col("_top._u").alias(top_user),
                       F.col("_top._c").alias(top_count))
