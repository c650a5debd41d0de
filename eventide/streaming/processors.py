"""Stateful streaming operators on ``transformWithStateInPandas``.

Each processor keeps per-key state in the state store (RocksDB) and, for
event-time logic, timers.  Spark hands a processor all rows of a key in a
micro-batch at once, unordered, and checks timers only after the batch;
the per-record semantics of the original jobs are kept by replaying a key's
rows in event-time order (``replay.Replayed``: sorted blocks, merged from
runs) and firing due timers between rows ("virtual timers"); real timers
then only close keys that receive no further rows.

A bounded input closes every timer and partial match at its end; a stream
does so only up to its watermark, so a stream's output equals the part of
the batch result that the watermark has closed.

``apply_*`` functions wire a processor to a DataFrame grouped by its key.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import IntegralType
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventide.operators.usercode import KeyedProcess, KeyedRun
from eventide.streaming.replay import Replayed, in_runs


def _key_type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _frame(columns: list[str], rows: list[tuple], nullable_ints: tuple = ()) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=columns)
    for c in nullable_ints:
        pdf[c] = pd.array(pdf[c].tolist(), dtype="Int64")
    return pdf


# --- periodic count with an anchored event-time timer ------------------------------

class PeriodicCount(Replayed):
    """First event arms a timer ``period_ms`` later; on firing, emit the
    key's cumulative count and disarm; the next later event re-arms."""

    def __init__(self, period_ms: int, time_col: str):
        self.period, self.time_col, self.order = int(period_ms), time_col, [time_col]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.count = handle.getValueState("count", "count bigint")
        self.armed = handle.getValueState("armed", "armed bigint")

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        t = pdf[self.time_col].to_numpy(dtype=np.int64)
        base = self.count.get()[0] if self.count.exists() else 0
        old = self.armed.get()[0] if self.armed.exists() else None
        armed, out, i = old, [], 0
        while i < len(t):
            if armed is None:
                armed = int(t[i]) + self.period
            j = int(np.searchsorted(t, armed, side="right"))
            if j >= len(t):
                break
            out.append((key[0], armed, base + j))      # virtual timer between rows
            armed, i = None, j
        self.count.update((base + len(t),))
        if armed != old:
            if old is not None:
                self.handle.deleteTimer(old)
            if armed is not None:
                self.handle.registerTimer(armed)
        if armed is None:
            self.armed.clear()
        else:
            self.armed.update((armed,))
        if out:
            yield _frame(["key", "fire_ts", "pv"], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if self.armed.exists() and self.armed.get()[0] == fired:
            self.armed.clear()
            yield _frame(["key", "fire_ts", "pv"], [(key[0], fired, self.count.get()[0])])


def apply_periodic_count(df: DataFrame, key: str, time_col: str, period_ms: int) -> DataFrame:
    schema = f"key {_key_type(df, key)}, fire_ts bigint, pv bigint"
    out = df.groupBy(key).transformWithStateInPandas(
        in_runs(PeriodicCount(period_ms, time_col), df), schema, "Append", "EventTime")
    return out.withColumnRenamed("key", key)


# --- count-triggered averages -----------------------------------------------------------

class CountWindowAverage(Replayed):
    """Average event time per n events of a key.  ``repeat=True``: every n
    events, then start over; ``repeat=False``: once, at the n-th event."""

    def __init__(self, n: int, time_col: str, order: list[str], repeat: bool = True):
        self.n, self.time_col, self.order, self.repeat = int(n), time_col, order, repeat

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("acc", "total bigint, sum bigint")

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        t = pdf[self.time_col].to_numpy(dtype=np.int64)
        total, acc = self.state.get() if self.state.exists() else (0, 0)
        used = t if self.repeat else t[:max(0, self.n - total)]
        sums = np.r_[0, acc + np.cumsum(used)]
        nth = total + np.arange(1, len(used) + 1)
        ends = np.flatnonzero(nth % self.n == 0)  # the events that fill a window
        full = np.diff(np.r_[0, sums[ends + 1]])
        left = sums[-1] - (sums[ends[-1] + 1] if len(ends) else 0) if len(used) else acc
        self.state.update((total + len(t), int(left)))
        if len(ends):
            yield pd.DataFrame({"key": [key[0]] * len(ends), "window_no": nth[ends] // self.n - 1, "avg_ts": full // self.n})


def apply_count_window_avg(df: DataFrame, key: str, time_col: str, order: list[str], n: int,
                           repeat: bool = True) -> DataFrame:
    schema = f"key {_key_type(df, key)}, window_no bigint, avg_ts bigint"
    out = df.groupBy(key).transformWithStateInPandas(
        in_runs(CountWindowAverage(n, time_col, order, repeat), df), schema, "Append", "None")
    out = out.withColumnRenamed("key", key)
    return out if repeat else out.drop("window_no")


# --- the n best items of a window -----------------------------------------------------------

def best_items(pdf: pd.DataFrame, n: int) -> pd.DataFrame:
    """The n rows with the largest ``cnt``; ties to the smaller item, null first."""
    return pdf.sort_values(["cnt", "item_known", "item"], ascending=[False, True, True], kind="stable").head(n)


class BestOfTask:
    """The n best items of each window among a task's rows (before the shuffle)."""

    HELD = ["window_start", "window_end", "cnt", "item_known", "item"]

    def __init__(self, n: int, most_windows: int = 1_000):
        self.n, self.most = int(n), most_windows

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {}
        for pdf in frames:
            for window, rows in pdf.groupby(["window_start", "window_end"], sort=False):
                if window in best:
                    rows = pd.concat([best[window], rows[self.HELD]], ignore_index=True)
                best[window] = best_items(rows[self.HELD], self.n)
            if len(best) > self.most:
                yield pd.concat(best.values(), ignore_index=True)
                best = {}
        if best:
            yield pd.concat(best.values(), ignore_index=True)


class TopOfWindow(StatefulProcessor):
    """Keeps the n best items of a window and reports them, ranked, when the
    watermark has reached the window's end.  The state is n entries."""

    def __init__(self, n: int, item_type: str):
        self.n, self.item_type = int(n), item_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", f"cnt bigint, item_known boolean, item {self.item_type}")

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.best.get()) if self.best.exists() else [], columns=BestOfTask.HELD[2:])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = self._held()
        if not len(best):
            self.handle.registerTimer(int(key[1]) - 1)      # due once the watermark has passed it
        for pdf in rows:
            frames = [f for f in (best, pdf[BestOfTask.HELD[2:]]) if len(f)]
            best = best_items(pd.concat(frames, ignore_index=True), self.n)
        self.best.put(list(best.astype(object).itertuples(index=False, name=None)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = self._held()
        self.best.clear()
        yield pd.DataFrame({"window_start": [key[0]] * len(best), "window_end": [key[1]] * len(best),
                            "item_known": best["item_known"].astype(bool), "item": best["item"], "cnt": best["cnt"],
                            "place": np.arange(1, len(best) + 1)})

    def close(self) -> None:
        pass


def apply_top_of_window(counts: DataFrame, item: str, count: str, n: int, rank: str) -> DataFrame:
    """``counts``: a stream of window_start, window_end, ``item`` and its
    ``count``, each window's rows after the watermark has reached its end."""
    kind = counts.schema[item].dataType
    name = kind.simpleString()
    # whole numbers beside a null would reach pandas as floats
    known = F.col(item).isNotNull()
    there = F.coalesce(F.col(item), F.lit(0).cast(kind)) if isinstance(kind, IntegralType) else F.col(item)
    fields = f"cnt bigint, item_known boolean, item {name}"
    few = (counts.select("window_start", "window_end", F.col(count).cast("bigint").alias("cnt"),
                         known.alias("item_known"), there.alias("item"))
           .mapInPandas(BestOfTask(n), f"window_start bigint, window_end bigint, {fields}"))
    top = few.groupBy("window_start", "window_end").transformWithStateInPandas(
        TopOfWindow(n, name), f"window_start bigint, window_end bigint, item_known boolean, item {name}, cnt bigint, place int",
        "Append", "EventTime")
    return top.select("window_start", "window_end", F.when(F.col("item_known"), F.col("item")).alias(item),
                      F.col("cnt").alias(count), F.col("place").alias(rank))


# --- hand-made tumbling window on map state ------------------------------------------------

class WindowCountByMap(StatefulProcessor):
    """Events per tumbling window of a key, counted in a map from window
    start to count; a timer at a window's last millisecond reports its count
    and drops the entry.  Rows of windows already closed are dropped."""

    def __init__(self, size_ms: int, time_col: str):
        self.size, self.time_col = int(size_ms), time_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "window_start bigint", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = Counter()
        for pdf in rows:
            t = pdf[self.time_col].to_numpy(np.int64)
            start, n = np.unique(t - t % self.size, return_counts=True)
            new.update(dict(zip(start.tolist(), n.tolist())))
        closed = timerValues.getCurrentWatermarkInMs()
        for s, k in sorted(new.items()):
            if s + self.size - 1 <= closed:
                continue
            if self.counts.containsKey((s,)):
                k += self.counts.getValue((s,))[0]
            else:
                self.handle.registerTimer(s + self.size - 1)
            self.counts.updateValue((s,), (k,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size + 1
        if self.counts.containsKey((start,)):
            n = self.counts.getValue((start,))[0]
            self.counts.removeKey((start,))
            yield _frame(["key", "window_start", "window_end", "pv"], [(key[0], start, start + self.size, n)])

    def close(self) -> None:
        pass


def apply_window_count_by_map(df: DataFrame, key: str, time_col: str, size_ms: int) -> DataFrame:
    schema = f"key {_key_type(df, key)}, window_start bigint, window_end bigint, pv bigint"
    out = df.groupBy(key).transformWithStateInPandas(WindowCountByMap(size_ms, time_col), schema, "Append", "EventTime")
    return out.withColumnRenamed("key", key)


# --- buffering sink ------------------------------------------------------------------------

class Buffer(Replayed):
    """Buffer rows; release them in batches of ``threshold`` in arrival
    order; the remainder stays in (checkpointed) list state."""

    def __init__(self, threshold: int, fields: list[str], field_ddl: str, order: list[str]):
        self.n, self.fields, self.ddl, self.order = int(threshold), fields, field_ddl, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.buffer = handle.getListState("buffer", self.ddl)
        self.batches = handle.getValueState("batches", "released bigint")

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        new = pdf[self.fields]
        held = list(self.buffer.get()) if self.buffer.exists() else []
        pending = held + list(new.itertuples(index=False, name=None))
        released = self.batches.get()[0] if self.batches.exists() else 0
        full = len(pending) // self.n
        out = []
        for b in range(full):
            for p, row in enumerate(pending[b * self.n:(b + 1) * self.n]):
                out.append((key[0], released + b, p + 1) + tuple(row))
        rest = pending[full * self.n:]
        if rest:
            self.buffer.put(rest)
        else:
            self.buffer.clear()
        self.batches.update((released + full,))
        if out:
            yield _frame(["shard", "batch_no", "pos"] + self.fields, out)


def apply_buffer(df: DataFrame, threshold: int, fields: list[str], order: list[str],
                 shards: int | None = None, shard_key: list[str] | None = None) -> DataFrame:
    """Buffering sink on a stream: one buffer per shard, like one buffering
    sink per parallel instance.  ``shards`` defaults to the shuffle
    parallelism; rows go to a shard by hash of ``shard_key`` (default: all
    ``fields``).  ``shards=1`` is the single-instance form, whose batches
    follow the global arrival order (what the batch form computes)."""
    ddl = ", ".join(f"{f} {df.schema[f].dataType.simpleString()}" for f in fields)
    if shards is None:
        shards = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shard = (F.pmod(F.hash(*(shard_key or fields)), F.lit(shards)) if shards > 1 else F.lit(0))
    schema = f"shard int, batch_no bigint, pos bigint, {ddl}"
    return (df.withColumn("shard", shard.cast("int")).groupBy("shard")
            .transformWithStateInPandas(in_runs(Buffer(threshold, fields, ddl, order), df), schema, "Append", "None"))


# --- strict event sequence ----------------------------------------------------------------

class StrictSequence(Replayed):
    """n adjacent events whose i-th satisfies predicate i (precomputed as
    boolean columns ``flags``); keeps the last n-1 events of the key."""

    def __init__(self, flags: list[str], time_col: str, order: list[str]):
        self.flags, self.time_col, self.order, self.n = flags, time_col, order, len(flags)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.tail = handle.getListState("tail", "ts bigint, flags array<boolean>")

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        held = list(self.tail.get()) if self.tail.exists() else []
        ts = np.r_[np.array([t for t, _ in held], np.int64), pdf[self.time_col].to_numpy(np.int64)]
        flags = np.vstack([np.array([list(f) for _, f in held], bool).reshape(-1, self.n),
                           pdf[self.flags].fillna(False).to_numpy(bool)])
        places = max(0, len(ts) - self.n + 1)
        hit = np.ones(places, bool)
        for i in range(self.n):
            hit &= flags[i:places + i, i]
        start = np.flatnonzero(hit)
        start = start[start + self.n - 1 >= len(held)]  # earlier ones were reported
        keep = range(max(0, len(ts) - self.n + 1), len(ts))
        if len(keep):
            self.tail.put([(int(ts[i]), flags[i].tolist()) for i in keep])
        else:
            self.tail.clear()
        if len(start):
            yield pd.DataFrame({"key": [key[0]] * len(start), **{f"ts_{i}": ts[start + i] for i in range(self.n)}})


def apply_strict_sequence(df: DataFrame, key: str, predicates: list, time_col: str,
                          order: list[str], step_names: list[str]) -> DataFrame:
    # (input columns must not start with "_": such names reach pandas renamed)
    flags = [f"step{i}_ok" for i in range(len(predicates))]
    tagged = df.select(key, *order, *[p.alias(f) for p, f in zip(predicates, flags)])
    schema = f"key {_key_type(df, key)}, " + ", ".join(f"ts_{i} bigint" for i in range(len(flags)))
    out = tagged.groupBy(key).transformWithStateInPandas(
        in_runs(StrictSequence(flags, time_col, order), tagged), schema, "Append", "None")
    return out.select(F.col("key").alias(key), *[F.col(f"ts_{i}").alias(n) for i, n in enumerate(step_names)])


# --- relaxed sequence with a deadline and time-out output -------------------------------

class FollowedByWithin(Replayed):
    """Every begin event waits for the first later end event of its key:
    matched when it comes within ``within_ms`` (strictly), otherwise timed
    out — by that end event, or by an event-time timer at begin + within."""

    COLS = ["key", "begin_ts", "begin_event_id", "end_ts", "end_event_id", "status", "timeout_ts"]

    def __init__(self, within_ms: int, time_col: str, id_col: str):
        self.within, self.time_col, self.id_col, self.order = int(within_ms), time_col, id_col, [time_col, id_col]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.open = handle.getListState("open", "ts bigint, id bigint")

    def _emit(self, out):
        return _frame(self.COLS, out, nullable_ints=("end_ts", "end_event_id", "timeout_ts"))

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        open_ = [(int(t), int(i)) for t, i in self.open.get()] if self.open.exists() else []
        out = []
        for t, i, b, e in zip(pdf[self.time_col], pdf[self.id_col], pdf["is_begin"], pdf["is_end"]):
            t, i = int(t), int(i)
            if e and open_:
                for bt, bi in open_:
                    if t - bt < self.within:
                        out.append((key[0], bt, bi, t, i, "matched", None))
                    else:
                        out.append((key[0], bt, bi, None, None, "timeout", bt + self.within))
                    self.handle.deleteTimer(bt + self.within)
                open_ = []
            if b:
                open_.append((t, i))
                self.handle.registerTimer(t + self.within)
        self.open.put(open_) if open_ else self.open.clear()
        if out:
            yield self._emit(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        open_ = [(int(t), int(i)) for t, i in self.open.get()] if self.open.exists() else []
        done = [(t, i) for t, i in open_ if t + self.within <= fired]
        rest = [(t, i) for t, i in open_ if t + self.within > fired]
        self.open.put(rest) if rest else self.open.clear()
        if done:
            yield self._emit([(key[0], t, i, None, None, "timeout", t + self.within) for t, i in done])


def apply_followed_by(df: DataFrame, key: str, time_col: str, id_col: str, begin, end,
                      within_ms: int) -> DataFrame:
    tagged = df.select(key, time_col, id_col, begin.alias("is_begin"), end.alias("is_end"))
    schema = (f"key {_key_type(df, key)}, begin_ts bigint, begin_event_id bigint, end_ts bigint, "
              "end_event_id bigint, status string, timeout_ts bigint")
    out = tagged.groupBy(key).transformWithStateInPandas(
        in_runs(FollowedByWithin(within_ms, time_col, id_col), tagged), schema, "Append", "EventTime")
    return out.withColumnRenamed("key", key)


# --- payment reconciliation with overwrite / consume --------------------------------------

class Reconcile(Replayed):
    """One pending event per side and id.  An event consumes a pending
    event of the other side (ok) or becomes the pending one of its side
    (overwriting) and arms a timer ``wait_ms`` later; a firing timer
    reports whatever is still pending as missing its counterpart.  Timers
    are not cancelled, like the original."""

    COLS = ["pay_id", "app_ts", "third_ts", "status"]

    def __init__(self, wait_ms: int):
        self.wait, self.order = int(wait_ms), ["ts", "side"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.app = handle.getValueState("app", "ts bigint")
        self.third = handle.getValueState("third", "ts bigint")

    def _fire(self, key, out):
        if self.app.exists():
            out.append((key[0], self.app.get()[0], None, "missing_third_party"))
            self.app.clear()
        if self.third.exists():
            out.append((key[0], None, self.third.get()[0], "missing_app"))
            self.third.clear()

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        out = []
        for t, side in zip(pdf["ts"], pdf["side"]):
            t = int(t)
            for due in sorted(self.handle.listTimers()):    # virtual timers before this row
                if due < t:
                    self.handle.deleteTimer(due)
                    self._fire(key, out)
            mine, other = (self.app, self.third) if side == "app" else (self.third, self.app)
            if other.exists():
                o = other.get()[0]
                out.append((key[0], t if side == "app" else o, o if side == "app" else t, "ok"))
                other.clear()
            else:
                mine.update((t,))
                self.handle.registerTimer(t + self.wait)
        if out:
            yield _frame(self.COLS, out, nullable_ints=("app_ts", "third_ts"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        self._fire(key, out)
        if out:
            yield _frame(self.COLS, out, nullable_ints=("app_ts", "third_ts"))


def apply_reconcile(app: DataFrame, third: DataFrame, id_col: str, app_ts: str, third_ts: str,
                    wait_ms: int, event_time: str = "event_time") -> DataFrame:
    """``app`` and ``third`` are watermarked streams; they are tagged and
    unioned, then grouped by payment id."""
    a = app.select(F.col(id_col).alias("pay_id"), F.col(app_ts).alias("ts"), F.lit("app").alias("side"), event_time)
    t = third.select(F.col(id_col).alias("pay_id"), F.col(third_ts).alias("ts"), F.lit("third").alias("side"), event_time)
    u = a.unionByName(t)
    schema = f"pay_id {u.schema['pay_id'].dataType.simpleString()}, app_ts bigint, third_ts bigint, status string"
    return u.groupBy("pay_id").transformWithStateInPandas(in_runs(Reconcile(wait_ms), u), schema, "Append", "EventTime")


# --- per-record rolling aggregate (changelog) ----------------------------------------------

def _value_type(df: DataFrame, value: str | None) -> str:
    """The state type of a value column: whole numbers stay whole."""
    return "bigint" if value is None or isinstance(df.schema[value].dataType, IntegralType) else "double"


def _values(pdf: pd.DataFrame, value: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Values as numpy numbers and which of them are there."""
    there = pdf[value].notna().to_numpy()
    return pdf[value].fillna(0).to_numpy(dtype=np.int64 if kind == "bigint" else np.float64), there


class RollingAggregate(Replayed):
    """One output row per input record with the key's running aggregate.
    Null values change nothing; before the first value it is null."""

    def __init__(self, kind: str, value: str | None, order: list[str], id_col: str, value_type: str):
        self.kind, self.value, self.order, self.id_col, self.type = kind, value, order, id_col, value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.acc = handle.getValueState("acc", f"acc {self.type}")

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        vals, there = ((np.ones(len(pdf), np.int64), np.ones(len(pdf), bool)) if self.kind == "count"
                       else _values(pdf, self.value, self.type))
        prev = self.acc.get()[0] if self.acc.exists() else None
        if self.kind in ("sum", "count"):
            run = np.cumsum(vals) + (prev or 0)
        else:
            scan, edge = (np.maximum, "min") if self.kind == "max" else (np.minimum, "max")
            least = getattr(np.iinfo(np.int64), edge) if self.type == "bigint" else (-np.inf if edge == "min" else np.inf)
            run = scan.accumulate(np.r_[least if prev is None else prev, np.where(there, vals, least)])[1:]
        known = np.logical_or.accumulate(there) | (prev is not None)
        if known[-1]:
            self.acc.update((run[-1].item(),))
        out = {"key": [key[0]] * len(pdf)}
        for c in dict.fromkeys([self.id_col, *self.order]):
            out[c] = pdf[c].to_numpy()
        out["running"] = pd.array(run, dtype="Int64" if self.type == "bigint" else "Float64")
        out["running"][~known] = pd.NA
        yield pd.DataFrame(out)


def apply_rolling(df: DataFrame, key: str, kind: str, value: str | None, order: list[str],
                  id_col: str, out: str) -> DataFrame:
    """One row per input record: key, ``id_col``, the order columns and the
    running aggregate ``out`` (bigint for whole numbers and counts, else double)."""
    passed, value_type = list(dict.fromkeys([id_col, *order])), _value_type(df, None if kind == "count" else value)
    schema = (f"key {_key_type(df, key)}, "
              + ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in passed)
              + f", running {value_type}")
    cols = [key, *passed] + ([value] if value else [])
    r = df.select(*dict.fromkeys(cols)).groupBy(key).transformWithStateInPandas(
        in_runs(RollingAggregate(kind, value, order, id_col, value_type), df), schema, "Append", "None")
    return r.select(F.col("key").alias(key), *passed, F.col("running").alias(out))


# --- own code per record --------------------------------------------------------------------

class KeyedUserCode(Replayed):
    """Drives a ``usercode.KeyedProcess``: its state and timers are kept
    pickled in value state, timers due between rows fire in between."""

    def __init__(self, code: KeyedProcess, fields: list[str], order: list[str]):
        self.code, self.fields, self.order = code, fields, order
        self.names = [f.name for f in T._parse_datatype_string(code.output).fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.run = handle.getValueState("run", "run binary")

    def _load(self, key) -> tuple[KeyedRun, set[int]]:
        if not self.run.exists():
            return KeyedRun(self.code, tuple(key)), set()
        state, timers = pickle.loads(self.run.get()[0])
        return KeyedRun(self.code, tuple(key), state, timers), set(timers)

    def _save(self, run: KeyedRun, known: set[int]) -> Iterator[pd.DataFrame]:
        # a timer is due once the watermark has passed it
        for at in known - run.armed:
            self.handle.deleteTimer(at + 1)
        for at in run.armed - known:
            self.handle.registerTimer(at + 1)
        if run.armed or run.state != self.code.start():
            self.run.update((pickle.dumps((run.state, sorted(run.armed))),))
        else:
            self.run.clear()
        if run.out:
            yield pd.DataFrame(run.taken(), columns=self.names, dtype=object)

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        pdf = pdf[self.fields].astype(object)
        columns = [pdf[f].where(pdf[f].notna(), None).tolist() for f in self.fields]
        run, known = self._load(key)
        time = self.fields.index(self.order[0])
        for values in zip(*columns):
            if values[time] is not None:
                run.event(int(values[time]), dict(zip(self.fields, values)))
        yield from self._save(run, known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run, known = self._load(key)
        at = expiredTimerInfo.getExpiryTimeInMs() - 1
        known.discard(at)           # it has gone off
        run.fire_before(at + 1)
        yield from self._save(run, known)


def apply_keyed_process(df: DataFrame, keys: list[str], order: list[str], code: KeyedProcess, fields: list[str]) -> DataFrame:
    """The stream form of ``usercode.keyed_process``: the same ``code``, which
    gets ``fields`` (keys and ``order`` among them) of each record."""
    fields = list(dict.fromkeys([*keys, *order, *fields]))
    return df.groupBy(*keys).transformWithStateInPandas(in_runs(KeyedUserCode(code, fields, order), df), code.output, "Append", "EventTime")


# --- arrival row + processing-time timer ----------------------------------------------------

class ArrivalTimer(StatefulProcessor):
    """On each row emit its arrival (processing time) and arm a
    processing-time timer ``delay_ms`` later; a timer emits its time."""

    def __init__(self, delay_ms: int, id_col: str):
        self.delay, self.id_col = int(delay_ms), id_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(now + self.delay)   # one timer per (key, ms)
        for pdf in rows:
            yield pd.DataFrame({"kind": "arrival", "event_id": pdf[self.id_col].astype("int64"),
                                "at_ms": np.int64(now)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield _frame(["kind", "event_id", "at_ms"],
                     [("timer", None, expiredTimerInfo.getExpiryTimeInMs())], nullable_ints=("event_id",))

    def close(self) -> None:
        pass


def apply_arrival_timer(df: DataFrame, id_col: str, key: Column, delay_ms: int = 1000) -> DataFrame:
    """``key`` is the key or a shard of the ids, which spreads the work;
    timers are unique per (key, ms)."""
    return (df.withColumn("timer_key", key).groupBy("timer_key")
            .transformWithStateInPandas(ArrivalTimer(delay_ms, id_col),
                                        "kind string, event_id bigint, at_ms bigint",
                                        "Append", "ProcessingTime"))


# --- process function that reads the watermark ------------------------------------------

class RepeatWithWatermark(StatefulProcessor):
    """Flat-map emitting each row ``times`` times (a precomputed column) and
    tagging it with the watermark the operator sees (``-1``/0 before the
    first watermark)."""

    def __init__(self, fields: list[str], times_col: str):
        self.fields, self.times_col = fields, times_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            rep = pdf.loc[pdf.index.repeat(pdf[self.times_col].clip(lower=0))][self.fields].copy()
            rep["watermark_ms"] = wm
            yield rep

    def close(self) -> None:
        pass


def apply_repeat_with_watermark(df: DataFrame, key: str, fields: list[str], times) -> DataFrame:
    tagged = df.withColumn("repeat_times", times)
    ddl = ", ".join(f"{f} {df.schema[f].dataType.simpleString()}" for f in fields)
    return tagged.groupBy(key).transformWithStateInPandas(
        RepeatWithWatermark(fields, "repeat_times"), f"{ddl}, watermark_ms bigint", "Append", "EventTime")


def apply_strict_sequence_flat(df: DataFrame, key: str, predicates: list, time_col: str,
                               order: list[str]) -> DataFrame:
    """``flatSelect`` on a stream: one row per matched event
    (key, ``match_ts`` = first event's time, ``step``, ``ts``)."""
    names = [f"step{i}_ts" for i in range(len(predicates))]
    m = apply_strict_sequence(df, key, predicates, time_col, order, names)
    e = m.select(key, F.col(names[0]).alias("match_ts"), F.posexplode(F.array(*names)).alias("step", "ts"))
    return e.select(key, "match_ts", F.col("step").cast("int").alias("step"), "ts")


class RollingExtremeBy(Replayed):
    """Per record: the key's record with the largest (``max``) or smallest
    (``min``) value so far; the first such record wins ties, nulls never do."""

    def __init__(self, kind: str, value: str, order: list[str], id_col: str, value_type: str):
        self.kind, self.value, self.order, self.id_col, self.type = kind, value, order, id_col, value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.best = handle.getValueState("best", f"value {self.type}, id bigint")

    def take(self, key, pdf) -> Iterator[pd.DataFrame]:
        vals, there = _values(pdf, self.value, self.type)
        ids = pdf[self.id_col].to_numpy(dtype=np.int64)
        best = self.best.get() if self.best.exists() else None
        if best is not None:  # the best so far as a record before these
            vals, there, ids = np.r_[vals.dtype.type(best[0]), vals], np.r_[True, there], np.r_[best[1], ids]
        place = np.flatnonzero(there)
        sign = vals[place] if self.kind == "max" else -vals[place]
        new = np.r_[True, sign[1:] > np.maximum.accumulate(sign)[:-1]] if len(place) else np.empty(0, bool)
        at = np.full(len(vals), -1)
        at[place[new]] = place[new]
        at = np.maximum.accumulate(at)[len(vals) - len(pdf):]
        if at[-1] >= 0:
            self.best.update((vals[at[-1]].item(), int(ids[at[-1]])))
        value = pd.array(vals[np.maximum(at, 0)], dtype="Int64" if self.type == "bigint" else "Float64")
        record = pd.array(ids[np.maximum(at, 0)], dtype="Int64")
        value[at < 0], record[at < 0] = pd.NA, pd.NA
        yield pd.DataFrame({"key": [key[0]] * len(pdf), self.id_col: pdf[self.id_col].to_numpy(),
                            "best_value": value, "best_id": record})


def apply_rolling_extreme_by(df: DataFrame, key: str, kind: str, value: str, order: list[str],
                             id_col: str) -> DataFrame:
    value_type = _value_type(df, value)
    schema = f"key {_key_type(df, key)}, {id_col} bigint, best_value {value_type}, best_id bigint"
    cols = list(dict.fromkeys([key, id_col, *order, value]))
    r = df.select(*cols).groupBy(key).transformWithStateInPandas(
        in_runs(RollingExtremeBy(kind, value, order, id_col, value_type), df), schema, "Append", "None")
    return r.withColumnRenamed("key", key)
