"""Own code on keys, windows and running values.

Three forms take a user's Python code where built-in expressions do not
reach; each is spread by Spark and none collects a group:

* ``KeyedProcess`` - code per record with keyed state and event-time timers.
  ``keyed_process`` is the batch form, ``streaming.processors.apply_keyed_process``
  the stream; both drive the same object through the same ``KeyedRun``.
  ``connect`` makes one input of two, for code that treats the sides apart.
* ``UserAggregate`` - own accumulators per (window, keys), made where the rows
  are, merged after one shuffle.
* ``running_reduce`` - the running value of any associative function, as a
  prefix scan over slices of the order.

The built-in forms (``windows``, ``rolling``) stay inside the JVM and are
faster wherever they can say the same.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from eventide.operators.windows import _window_starts
from eventide.plans.ordered import slice_column

OUT_ROWS = 10_000


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T._parse_datatype_string(ddl))


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _emitted(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= OUT_ROWS:
            yield _record_batch(held, schema)
            held = []
    if held:
        yield _record_batch(held, schema)


# --- code per record with state and timers ---------------------------------------------

class KeyedProcess:
    """User code over the records of a key, in event-time order.

    ``output`` is the DDL of the emitted rows.  ``start()`` gives a key's first
    state (any picklable object, None by default); ``on_event(ctx, row)`` and
    ``on_timer(ctx, at)`` may read and replace ``ctx.state``, set and delete
    timers, and emit rows.  A timer is one per (key, time); it fires when event
    time has passed it, so a record at the timer's own time comes first.  At
    the end of a bounded input all timers fire (``ctx.ended`` is then true:
    code that arms a timer in ``on_timer`` without end must look at it).
    """

    output = ""

    def start(self) -> Any:
        return None

    def on_event(self, ctx: KeyedRun, row: dict) -> None:
        raise NotImplementedError

    def on_timer(self, ctx: KeyedRun, at: int) -> None:
        pass


class KeyedRun:
    """State, timers and emitted rows of one key; what user code sees as ``ctx``."""

    def __init__(self, code: KeyedProcess, key: tuple, state: Any = ..., timers: list[int] = ()):
        self.code, self.key, self.ended, self.now = code, key, False, None
        self.state = code.start() if state is ... else state
        self.armed, self.heap, self.out = set(timers), sorted(timers), []

    def emit(self, *values) -> None:
        self.out.append(values)

    def set_timer(self, at: int) -> None:
        if at not in self.armed:
            self.armed.add(at)
            heapq.heappush(self.heap, at)

    def delete_timer(self, at: int) -> None:
        self.armed.discard(at)          # its entry in the heap is passed over

    def fire_before(self, t: int | None) -> None:
        """Fire the timers before ``t`` (all, if None), in order."""
        while self.heap and (t is None or self.heap[0] < t):
            at = heapq.heappop(self.heap)
            if at in self.armed:
                self.armed.discard(at)
                self.now = at
                self.code.on_timer(self, at)

    def event(self, t: int, row: dict) -> None:
        self.fire_before(t)
        self.now = t
        self.code.on_event(self, row)

    def end(self) -> None:
        self.ended = True
        self.fire_before(None)

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def keyed_process(df: DataFrame, keys: list[str], order: list[str], code: KeyedProcess) -> DataFrame:
    """Run ``code`` over each key's records in ``order``, whose first column is
    the event time (a whole number).

    Records are shuffled by key once and sorted; a task streams through them
    holding one key's state and timers, whatever the number of its records.
    Code over one key's state is sequential by its nature, so one key is one
    task.  Rows without a time are left out; null keys are one key.
    """
    schema, fields, time = _arrow_schema(code.output), list(dict.fromkeys([*keys, *df.columns])), order[0]
    at, n = fields.index(time), len(keys)

    def run(batches):
        def rows():
            one = None
            for values in _records(batches):
                key = values[:n]
                if one is None or one.key != key:
                    if one is not None:
                        one.end()
                        yield from one.taken()
                    one = KeyedRun(code, key)
                one.event(values[at], dict(zip(fields, values)))
                yield from one.taken()
            if one is not None:
                one.end()
                yield from one.taken()
        yield from _emitted(rows(), schema)

    return (df.where(F.col(time).isNotNull()).select(*fields).repartition(*keys).sortWithinPartitions(*keys, *order)
            .mapInArrow(run, code.output))


def connect(left: DataFrame, right: DataFrame, side: str = "side") -> DataFrame:
    """Two inputs as one: all columns of both (null where an input has none)
    and ``side``, 0 for left and 1 for right."""
    return (left.withColumn(side, F.lit(0)).unionByName(right.withColumn(side, F.lit(1)), allowMissingColumns=True))


# --- own accumulators ----------------------------------------------------------------------

class UserAggregate:
    """Accumulators of the user's making: ``create``, ``add(acc, row)`` and
    ``merge(a, b)`` return an accumulator (any picklable object, changed in
    place or new), ``result(acc)`` the values of the ``output`` columns."""

    output = ""

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, acc: Any, row: dict) -> Any:
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def result(self, acc: Any) -> tuple:
        raise NotImplementedError


class WindowReduce(UserAggregate):
    """``fn`` folded over a column: a reduce as an aggregate."""

    def __init__(self, column: str, fn: Callable[[Any, Any], Any], output: str):
        self.column, self.fn, self.output = column, fn, output

    def create(self):
        return ()

    def add(self, acc, row):
        return (self.fn(acc[0], row[self.column]),) if acc else (row[self.column],)

    def merge(self, a, b):
        return (self.fn(a[0], b[0]),) if a and b else a or b

    def result(self, acc):
        return acc


HELD_GROUPS = 20_000        # accumulators of a task before they are handed on


def window_aggregate(df: DataFrame, time_col: str, size_ms: int, slide_ms: int | None, keys: list[str],
                     code: UserAggregate, held: int = HELD_GROUPS) -> DataFrame:
    """``code`` per window and ``keys``; ``time_col`` is epoch ms.

    A task makes one accumulator for each (pane, keys) it meets, ``held`` at a
    time, and hands them on pickled; after one shuffle the accumulators of a
    group are merged as they come.  A hot group is as many accumulators as
    tasks met it.  Panes are one slide wide and are copied to their windows as
    accumulators, not as records.  Rows without a time are left out.
    """
    slide = slide_ms or size_ms
    if size_ms % slide:
        raise ValueError("the size must be a multiple of the slide")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    n, fields = len(keys), list(dict.fromkeys([*keys, *df.columns]))
    key_ddl = "".join(f", {k} {types[k]}" for k in keys)
    partial_ddl, out_ddl = f"_pane bigint{key_ddl}, _acc binary", f"window_start bigint, window_end bigint{key_ddl}, {code.output}"
    partial_schema, out_schema = _arrow_schema(partial_ddl), _arrow_schema(out_ddl)
    at = fields.index(time_col)

    def partial(batches):
        def rows():
            groups: dict[tuple, Any] = {}
            for values in _records(batches):
                group = (values[at] - values[at] % slide, *values[:n])
                if group not in groups and len(groups) >= held:
                    yield from ((*g, pickle.dumps(a)) for g, a in groups.items())
                    groups = {}
                acc = groups[group] if group in groups else code.create()
                groups[group] = code.add(acc, dict(zip(fields, values)))
            yield from ((*g, pickle.dumps(a)) for g, a in groups.items())
        yield from _emitted(rows(), partial_schema)

    def merged(batches):
        def rows():
            group, acc = None, None
            for *g, _, a in _records(batches):
                if g == group:
                    acc = code.merge(acc, pickle.loads(a))
                    continue
                if group is not None:
                    yield (group[0], group[0] + size_ms, *group[1:], *code.result(acc))
                group, acc = g, pickle.loads(a)
            if group is not None:
                yield (group[0], group[0] + size_ms, *group[1:], *code.result(acc))
        yield from _emitted(rows(), out_schema)

    panes = df.where(F.col(time_col).isNotNull()).select(*fields).mapInArrow(partial, partial_ddl)
    by = ["window_start", *keys]
    copied = panes.withColumn("window_start", _window_starts("_pane", size_ms, slide)).select(*by, "_pane", "_acc")
    return copied.repartition(*by).sortWithinPartitions(*by, "_pane").mapInArrow(merged, out_ddl)


# --- running reduce -------------------------------------------------------------------------

def running_reduce(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                   fn: Callable[[tuple, tuple], tuple], out: list[str]) -> DataFrame:
    """``df`` with ``out``: the reduce of ``values`` over a key's rows up to each row.

    ``fn(earlier, later)`` is associative and returns a tuple of the types of
    ``values``; it need not commute.  ``order`` ends in a unique tie-breaker.
    A key is cut into slices of the order: every (key, slice) is folded by
    itself, a key's totals (at most one for a slice) are folded in order, and
    a second pass over the slices begins with what came before.  Rows whose
    values are all null keep the value before them.
    """
    if not keys:
        df = df.withColumn("_all", F.lit(0))
    group = keys or ["_all"]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    n, m = len(group), len(values)
    sliced = df.withColumn("_slice", slice_column(df, order))
    key_ddl = ", ".join(f"_k{i} {types[k]}" for i, k in enumerate(group))
    value_ddl = ", ".join(f"_v{i} {types[v]}" for i, v in enumerate(values))
    total_ddl = f"{key_ddl}, _s int, {value_ddl}"
    total_schema = _arrow_schema(total_ddl)

    def fold(acc, value):
        return acc if all(v is None for v in value) else value if acc is None else fn(acc, value)

    def totals(batches):
        def rows():
            group, acc = None, None
            for row in _records(batches):
                if row[:n + 1] != group:
                    if group is not None and acc is not None:
                        yield (*group, *acc)
                    group, acc = row[:n + 1], None
                acc = fold(acc, row[n + 1:])
            if group is not None and acc is not None:
                yield (*group, *acc)
        yield from _emitted(rows(), total_schema)

    def prefixes(batches):
        """Each slice's total becomes what all slices up to it give."""
        def rows():
            key, acc = None, None
            for row in _records(batches):
                if row[:n] != key:
                    key, acc = row[:n], None
                acc = fold(acc, row[n + 1:])
                yield (*row[:n + 1], *acc)
        yield from _emitted(rows(), total_schema)

    passed = [c for c in df.columns if c not in out and c != "_all"]
    scan_ddl = ", ".join(f"{c} {types[c]}" for c in passed) + ", " + ", ".join(f"{o} {types[v]}" for o, v in zip(out, values))
    scan_schema = _arrow_schema(scan_ddl)

    def scanned(batches):
        def rows():
            group, acc = None, None
            for row in _records(batches):
                head, value, before, rest = row[:n + 1], row[n + 1:n + 1 + m], row[n + 1 + m:n + 1 + 2 * m], row[n + 1 + 2 * m:]
                if head != group:
                    group, acc = head, None if all(v is None for v in before) else before
                acc = fold(acc, value)
                yield (*rest, *(acc or (None,) * m))
        yield from _emitted(rows(), scan_schema)

    by, names, heads = [*group, "_slice"], [f"_k{i}" for i in range(n)], [f"_v{i}" for i in range(m)]
    dealt = sliced.repartition(*by).sortWithinPartitions(*by, *order)
    summed = dealt.select(*by, *values).mapInArrow(totals, total_ddl)
    upto = summed.repartition(*names).sortWithinPartitions(*names, "_s").mapInArrow(prefixes, total_ddl)
    # a slice begins with the last prefix before it; at most two rows of a key for each slice
    begins = sliced.select(*[F.col(k).alias(x) for k, x in zip(group, names)], F.col("_slice").alias("_s")).distinct()
    marked = begins.withColumn("_has", F.lit(False)).unionByName(upto.withColumn("_has", F.lit(True)), allowMissingColumns=True)
    along = Window.partitionBy(*names).orderBy("_s", "_has").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("_has"), F.struct(*heads)), ignorenulls=True).over(along)
    before = marked.withColumn("_p", last).where(~F.col("_has")).select(*names, "_s", *[F.col(f"_p.{v}").alias(v) for v in heads])
    same = [F.col(k).eqNullSafe(F.col(x)) for k, x in zip(group, names)]
    return (sliced.join(before, [*same, F.col("_slice") == F.col("_s")], "left")
            .repartition(*by).sortWithinPartitions(*by, *order)
            .select(*by, *values, *heads, *passed).mapInArrow(scanned, scan_ddl))
