"""Batch forms of the keyed-state / timer jobs.

Each function gives the result a bounded stream produces once its input has
ended (the watermark then passes every timer).  The streaming forms with
real state and timers are in ``eventide.streaming.processors``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from eventide.plans.ordered import sequence_number, slice_column


def count_window_avg(df: DataFrame, key: str, order: list[str], time_col: str, n: int = 5,
                     out: str = "avg_ts") -> DataFrame:
    """Every n events of a key: the average of their times (integer ms,
    truncated), then start over.  A trailing group with fewer than n events
    has not fired yet and is not reported.  Output: key, ``window_no``
    (0-based), ``avg_ts``."""
    s = sequence_number(df, [key], order, out="_seq")
    g = (s.withColumn("window_no", F.expr("(_seq - 1) div " + str(int(n))))
         .groupBy(key, "window_no")
         .agg(F.count(F.lit(1)).alias("_n"), F.sum(time_col).alias("_sum")))
    return (g.where(F.col("_n") == n)
            .select(key, "window_no", F.expr(f"_sum div {int(n)}").alias(out)))


def nth_event_avg(df: DataFrame, key: str, order: list[str], time_col: str, n: int = 6,
                  out: str = "avg_ts") -> DataFrame:
    """Once per key, when its n-th event arrives: the average time of its
    first n events (integer ms).  Keys with fewer than n events emit
    nothing."""
    # ``row_number() <= n`` is planned as a WindowGroupLimit: each map
    # partition keeps at most n rows per key before the shuffle, so even a
    # huge key ships only n rows per partition.
    w = Window.partitionBy(key).orderBy(*[F.col(o) for o in order])
    s = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    g = s.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(time_col).alias("_sum"))
    return g.where(F.col("_n") == n).select(key, F.expr(f"_sum div {int(n)}").alias(out))


def arrival_and_timer(df: DataFrame, key: str | None, time_col: str, id_col: str,
                      delay_ms: int = 1000) -> DataFrame:
    """Each event emits an ``arrival`` row at its time and registers a timer
    ``delay_ms`` later; timers are unique per (key, time), so each distinct
    fire time of a key emits one ``timer`` row.

    Output: ``kind, <key>, event_id (null for timers), at_ms``.
    """
    keys = [key] if key else []
    arrivals = df.select(F.lit("arrival").alias("kind"), *keys,
                         F.col(id_col).alias("event_id"), F.col(time_col).alias("at_ms"))
    timers = (df.select(*keys, (F.col(time_col) + F.lit(delay_ms)).alias("at_ms")).distinct()
              .select(F.lit("timer").alias("kind"), *keys,
                      F.lit(None).cast("bigint").alias("event_id"), "at_ms"))
    return arrivals.unionByName(timers)


def buffered_batches(df: DataFrame, order: list[str], threshold: int = 10) -> DataFrame:
    """Buffering sink: rows in arrival order are released in batches of
    ``threshold``; rows of an incomplete last batch stay buffered (they are
    in the checkpointed state in the streaming form, not in the output).

    Adds ``batch_no`` (0-based) and ``pos`` (1..threshold).  The global
    arrival order is numbered by ``sequence_number`` in slices, not in one
    task.
    """
    s = sequence_number(df, [], order, out="_seq")
    s = (s.withColumn("batch_no", F.expr(f"(_seq - 1) div {int(threshold)}"))
         .withColumn("pos", F.expr(f"(_seq - 1) % {int(threshold)} + 1")))
    full = df.count() // int(threshold)  # batches; the rest stays buffered
    return s.where(F.col("batch_no") < full).drop("_seq")


def _whole_groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[tuple[list[np.ndarray], list[list]]]:
    """Arrow batches sorted by their first ``by`` columns as chunks of whole groups.

    Yields the group starts (n + 1) with the other columns as arrays, and the
    first ``by`` columns' values of each group; the last group of a batch
    waits for the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        if not held.num_rows:
            continue
        starts = _group_starts(held, by)
        if len(starts) > 1:
            yield _chunk(held.slice(0, starts[-1]), starts, by)
            held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield _chunk(held, np.append(_group_starts(held, by), held.num_rows), by)


def _group_starts(table: pa.Table, by: int) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in range(by):
        code = table.column(k).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(new)


def _chunk(table: pa.Table, starts: np.ndarray, by: int) -> tuple[list[np.ndarray], list[list]]:
    heads = [table.column(k).take(pa.array(starts[:-1])).to_pylist() for k in range(by)]
    return [starts, *(table.column(k).to_numpy() for k in range(by, table.num_columns))], heads


def _chain_batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    types = (key_type, pa.int32(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["k", "s", "armed", "before", "over"])


def _followers(t: np.ndarray, group: np.ndarray, ends: np.ndarray, period: int) -> np.ndarray:
    """For each row the first row of its group that is later by more than
    ``period``, or the group's end."""
    low = int(t.min())
    span = int(t.max()) - low + period + 2
    if span * (int(group[-1]) + 1) < 1 << 62:      # all groups at once, one behind the other
        place = group * span + (t - low)
        return np.minimum(np.searchsorted(place, place + period, side="right"), ends[group])
    out = np.empty(len(t), np.int64)
    for a, b in zip(np.append(0, ends[:-1]), ends):
        out[a:b] = a + np.searchsorted(t[a:b], t[a:b] + period, side="right")
    return out


def periodic_counts(df: DataFrame, key: str, time_col: str, period_ms: int,
                    out: str = "pv") -> DataFrame:
    """Periodic per-key count with an anchored timer.

    The first event of a key arms a timer ``period_ms`` later; when it fires
    it reports the key's cumulative event count (events with time <= the
    fire time) and disarms; the next later event re-arms.  At end of input
    the armed timer fires too.  Output: key, ``fire_ts``, ``out``.

    The anchors form a chain: each depends on the fire time before it.  A
    key's time is cut into slices (``plans.ordered``).  A timer armed before a
    slice fires less than a period after the slice's first event, so the
    chain can enter the slice only at an event of that period or at the first
    one after it; a first pass maps each such entry to the timer the slice
    leaves armed (pointers to the next anchor, doubled).  The maps of a key,
    at most one for a slice, are followed in order, and a second pass over
    the slices, each knowing the timer it begins with, writes the firings.
    """
    P, kind = int(period_ms), df.schema[key].dataType.simpleString()
    key_type = to_arrow_type(df.schema[key].dataType)
    timed = df.where(F.col(time_col).isNotNull())
    sliced = timed.select(F.col(key).alias("k"), slice_column(timed, [time_col]).alias("s"), F.col(time_col).cast("bigint").alias("t"))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (starts, t), (keys, slices) in _whole_groups(batches, 2):
            ends, row = starts[1:], np.arange(len(t))
            group = np.repeat(np.arange(len(ends)), np.diff(starts))
            follow = _followers(t, group, ends, P)
            end = np.where(follow < ends[group], follow, row)
            while True:             # every group's pointers at once
                jumped = end[end]
                if (jumped == end).all():
                    break
                end = jumped
            entry = row <= follow[starts[:-1]][group]
            entry[1:] &= (t[1:] != t[:-1]) | (group[1:] != group[:-1])
            some = np.flatnonzero(entry)
            cuts = pa.array(np.searchsorted(some, starts), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int64())) for x in (t[some], t[end[some]] + P)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array(slices, pa.int32()), pa.array(np.diff(starts), pa.int64()), *lists],
                                             names=["k", "s", "n", "entry", "leave"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, armed, n = ..., None, 0
        for batch in batches:       # a row for each slice of a key, in order
            found = []
            for k, s, size, entry, leave in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if key is not ...:
                        found.append((key, None, armed, n, True))
                    key, armed, n = k, None, 0
                found.append((k, s, armed, n, False))
                i = 0 if armed is None else bisect_right(entry, armed)
                if i < len(entry):
                    armed = leave[i]
                n += size
            yield _chain_batch(found, key_type)
        if key is not ...:
            yield _chain_batch([(key, None, armed, n, True)], key_type)

    def firings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (starts, t, armed, before), (keys, _) in _whole_groups(batches, 2):
            first, ends = starts[:-1], starts[1:]
            group = np.repeat(np.arange(len(ends)), np.diff(starts))
            follow = _followers(t, group, ends, P)
            at = np.where(np.isnan(armed[first]), t[first] + P, armed[first]).astype(np.int64) if armed.dtype.kind == "f" else armed[first]
            due = t > at[group]     # rows behind the timer that the group begins with
            row = ends - np.bincount(group, weights=due, minlength=len(ends)).astype(np.int64)
            live, out_group, out_at, out_n = np.arange(len(ends)), [], [], []
            while True:             # one firing of every group that still has one
                live = live[row[live] < ends[live]]
                if not len(live):
                    break
                out_group.append(live)
                out_at.append(at[live])
                out_n.append(before[first[live]] + row[live] - first[live])
                at[live] = t[row[live]] + P
                row[live] = follow[row[live]]
            if out_group:
                g = np.concatenate(out_group)
                yield pa.RecordBatch.from_arrays([pa.array(keys, key_type).take(pa.array(g)), pa.array(np.concatenate(out_at)),
                                                  pa.array(np.concatenate(out_n).astype(np.int64))], names=[key, "fire_ts", out])

    maps = (sliced.repartition("k", "s").sortWithinPartitions("k", "s", "t")
            .mapInArrow(entries, f"k {kind}, s int, n bigint, entry array<bigint>, leave array<bigint>"))
    chain = (maps.repartition("k").sortWithinPartitions("k", "s")
             .mapInArrow(chained, f"k {kind}, s int, armed bigint, before bigint, over boolean"))
    # null keys match as structs
    begin = chain.where(~F.col("over")).select(F.struct("k").alias("bk"), F.col("s").alias("bs"), "armed", "before")
    inner = (sliced.withColumn("lk", F.struct("k")).join(begin, (F.col("lk") == F.col("bk")) & (F.col("s") == F.col("bs")))
             .select("k", "s", "t", "armed", "before"))
    schema = f"{key} {kind}, fire_ts bigint, {out} bigint"
    fired = inner.sortWithinPartitions("k", "s", "t").mapInArrow(firings, schema)
    last = chain.where("over").select(F.col("k").alias(key), F.col("armed").alias("fire_ts"), F.col("before").alias(out))
    return fired.unionByName(last)
