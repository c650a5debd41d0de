"""Ordered per-key scans that stay parallel when one key is huge.

Running aggregates ("sum so far for this user"), sequence numbers and the
like need every row of a key in order.  ``Window.partitionBy(key)`` puts each
key into a single task.  Here every key is cut into the same *slices* of the
order, at every size and for every key:

1. Slice bounds are quantiles of the order over all rows (one aggregation of
   one column), so slices hold about equally many rows however the times are
   spread; a time that alone holds several quantiles is cut again at
   quantiles of the tie-breaker.  Only the bounds, at most ``slices`` values,
   come to the driver; they become a literal expression.
2. The aggregate is computed per ``(key, slice)``: one exchange, a hot key
   (or one global order) is spread over all slices.
3. Totals per ``(key, slice)`` (partially aggregated, no more than ``slices``
   rows for a key) are prefix-combined over the earlier slices and merged
   into the local values.

Keys are compared as one struct, so null keys match each other and the window
and the join share one exchange.  Supported are decomposable aggregates: sum,
count, max, min, and max_by / min_by, whose ties go to the earliest row
whatever the types of the value and the order.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

SLICES_CONF = "eventide.ordered.slices"
MAX_SLICES = 4096      # of a key; more bounds would not fit an expression

SLICE = "_slice"
_KEY = "_key"

_LOCAL = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "max_by": F.max, "min_by": F.min}
_PREFIX = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min, "max_by": F.max, "min_by": F.min}


def slice_count(df: DataFrame) -> int:
    """As many slices as the session has shuffle partitions, unless set."""
    conf = df.sparkSession.conf
    n = int(conf.get(SLICES_CONF, None) or conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(n, MAX_SLICES))


def slice_bounds(df: DataFrame, order: list[str], slices: int) -> list[tuple]:
    """Rising bounds ``(time, tie)`` that cut the rows into slices.

    ``tie`` is None for "at this time or later", a value for "at this time
    and from this tie-breaker on, or later", and ``...`` for "later".
    """
    time = order[0]
    points = [i / slices for i in range(1, slices)]
    values = df.agg(F.percentile_approx(time, points, 10 * slices).alias("p")).first()["p"] or []
    times = Counter(values)
    heavy, ties = {v: m for v, m in times.items() if m > 1}, {}
    if heavy and len(order) > 1 and isinstance(df.schema[order[1]].dataType, (NumericType, DateType, TimestampType, TimestampNTZType)):
        grid = max(heavy.values())
        rows = (df.where(F.col(time).isin(list(heavy))).groupBy(time)
                .agg(F.percentile_approx(order[1], [i / grid for i in range(1, grid)], 10 * grid).alias("p")).collect())
        ties = {r[time]: r["p"] for r in rows}  # at most ``slices`` values in all slices' grid
    bounds: list[tuple] = []
    for v in sorted(times):
        bounds.append((v, None))
        if v in heavy:
            cuts = ties.get(v) or []
            picked = sorted({cuts[round(j * len(cuts) / heavy[v])] for j in range(1, heavy[v])}) if cuts else []
            bounds += [(v, q) for q in picked] + [(v, ...)]
    return bounds


def slice_column(df: DataFrame, order: list[str], slices: int | None = None, like: DataFrame | None = None) -> Column:
    """The slice number of a row: non-decreasing along ``order``; rows without
    a time are in the first slice.  Runs the aggregation for the bounds now,
    over ``like`` if given: a frame with a column named like the order's first
    and spread about alike, which is cheaper to compute than ``df``."""
    bounds = slice_bounds(df, order, slices or slice_count(df)) if like is None else \
        slice_bounds(like, order[:1], slices or slice_count(df))
    time, tie = F.col(order[0]), F.col(order[1]) if len(order) > 1 else None

    def reached(bound: tuple) -> Column:
        v, q = bound
        if q is None:
            return time >= F.lit(v)
        if q is ...:
            return time > F.lit(v)
        return (time > F.lit(v)) | ((time == F.lit(v)) & (tie >= F.lit(q)))

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(reached(bounds[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(bounds))


def running(df: DataFrame, keys: list[str], order: list[str], aggs: dict[str, tuple], *,
            descending: bool = False, include_current: bool = True, like: DataFrame | None = None) -> DataFrame:
    """Running (cumulative, current row included) aggregates per key.

    ``order`` must end in a unique tie-breaker; its first column is a number
    or a time.  ``descending=True`` scans from the latest row backwards
    (suffix aggregates); ``include_current=False`` leaves the current row out.
    ``aggs`` maps output name to ``(kind, column)`` with kind in
    sum/count/max/min, or to ``("max_by" | "min_by", value, record)``: the
    struct ``record`` of the row with the largest (smallest) value so far,
    the first such row on ties, ignoring null values.  Empty ``keys`` means
    one global order.

    Several aggregates over the same key and order belong in one call (one
    pass, one shuffle).  ``like`` is passed on to ``slice_column``.
    """
    by = any(a[0].endswith("_by") for a in aggs.values())
    if by and descending:
        raise ValueError("max_by and min_by follow the order")
    c = df.withColumn(SLICE, slice_column(df, order, like=like))
    group = [SLICE]
    if keys:
        c = c.withColumn(_KEY, F.struct(*[F.col(k) for k in keys]))
        group = [_KEY, SLICE]
    ordering = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    along = Window.partitionBy(*group).orderBy(*ordering)
    w = along.rowsBetween(Window.unboundedPreceding, Window.currentRow if include_current else -1)

    values = {}
    for name, (kind, expr, *record) in aggs.items():
        if kind in ("max_by", "min_by"):
            sign = -1 if kind == "max_by" else 1  # the earliest row wins ties
            expr = F.when(expr.isNotNull(), F.struct(expr.alias("value"), (F.lit(sign) * F.col(SLICE)).alias("s"),
                                                     (F.lit(sign) * F.col("_nth")).alias("n"), record[0].alias("record")))
        values[name] = expr
    out = c.withColumn("_nth", F.row_number().over(along)) if by else c
    for name, (kind, *_) in aggs.items():
        out = out.withColumn(f"_loc_{name}", _LOCAL[kind](values[name]).over(w))

    if by:  # the place within the slice counts: totals are what its last row has
        every = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = out.withColumn("_last", F.lead(F.lit(1)).over(along).isNull())
        for name, (kind, *_) in aggs.items():
            last = last.withColumn(f"_tot_{name}", _LOCAL[kind](values[name]).over(every))
        totals = last.where("_last").select(*group, *[f"_tot_{n}" for n in aggs])
    else:
        totals = c.groupBy(*group).agg(*[_LOCAL[kind](values[n]).alias(f"_tot_{n}") for n, (kind, *_) in aggs.items()])
    # at most ``slices`` rows for a key; without keys the parts meet under one constant that is not folded away
    parts = [F.col(_KEY)] if keys else [F.col(SLICE) < 0]
    ahead = (Window.partitionBy(*parts).orderBy(F.col(SLICE).desc() if descending else F.col(SLICE).asc())
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*group, *[_PREFIX[kind](f"_tot_{n}").over(ahead).alias(f"_off_{n}") for n, (kind, *_) in aggs.items()])
    # the window output is partitioned by the join's keys: only the offsets move
    out = out.join(offsets, on=group, how="left")

    merged = []
    for name, (kind, *_) in aggs.items():
        loc, off = F.col(f"_loc_{name}"), F.col(f"_off_{name}")
        if kind == "count":
            value = F.coalesce(loc, F.lit(0)) + F.coalesce(off, F.lit(0))
        elif kind == "sum":
            value = F.when(off.isNull(), loc).when(loc.isNull(), off).otherwise(loc + off)
        else:
            value = (F.greatest if kind in ("max", "max_by") else F.least)(loc, off)
        merged.append((value["record"] if kind.endswith("_by") else value).alias(name))
    kept = [x for x in df.columns if x not in aggs]
    return out.select(*kept, *merged)


def sequence_number(df: DataFrame, keys: list[str], order: list[str], out: str = "seq") -> DataFrame:
    """1-based position of each row in its key's order (``row_number`` in slices)."""
    return running(df, keys, order, {out: ("count", F.lit(1))})
