"""Own code on keys, windows and running values: batch against plain Python,
stream against batch."""

import os
import random
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from data_dirs import SF_SMALL
from eventide import catalog
from eventide.operators import usercode
from eventide.session import shared_path
from eventide.sources.streams import event_stream
from eventide.sources.tables import events
from eventide.streaming import processors as P
from eventide.streaming import streams as S
from eventide.streaming.run import run_available
from streamutil import split_by_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers cannot import a test module

H = 3_600_000
ORDER = ["ts_ms", "event_id"]


@pytest.fixture(scope="module")
def folder(spark):
    path = shared_path(spark, "events-usercode")
    return path, split_by_time(spark, os.path.join(SF_SMALL, "events.parquet"), path, 5)


def _stream(spark, folder):
    path, schema = folder
    s = event_stream(spark, path, schema, max_files_per_trigger=1)
    return S.watermarked(s.select("event_id", "user_id", "event_type", "value", "ts_ms", "event_time"), "ts_ms", 0)


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Trace(usercode.KeyedProcess):
    """Emits all that happens: events with the state they meet, and timers."""

    output = "k string, what string, at bigint, n bigint"

    def start(self):
        return {"n": 0}

    def on_event(self, ctx, row):
        ctx.state["n"] += 1
        ctx.emit(ctx.key[0], "event", row["t"], ctx.state["n"])
        ctx.set_timer(row["t"] + 5)
        ctx.set_timer(row["t"] + 5)          # one timer per time
        if row["t"] % 3 == 0:
            ctx.delete_timer(row["t"] + 5)

    def on_timer(self, ctx, at):
        ctx.emit(ctx.key[0], "timer", at, ctx.state["n"])
        if at % 4 == 0 and not ctx.ended:
            ctx.set_timer(at + 2)            # timers may arm timers


def _trace(rows):
    out = []
    for k in {r[0] for r in rows}:
        n, armed = 0, set()

        def fire(before, ended, n, armed):
            while armed and (before is None or min(armed) < before):
                at = min(armed)
                armed.discard(at)
                out.append((k, "timer", at, n))
                if at % 4 == 0 and not ended:
                    armed.add(at + 2)

        for _, t, _ in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:]):
            fire(t, False, n, armed)
            n += 1
            out.append((k, "event", t, n))
            armed.add(t + 5)
            if t % 3 == 0:
                armed.discard(t + 5)
        fire(None, True, n, armed)
    return sorted(out, key=repr)


def test_keyed_process_against_plain_python(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.randint(0, 400), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t bigint, i bigint").repartition(5)
    got = usercode.keyed_process(df, ["k"], ["t", "i"], Trace())
    assert _set(got) == _trace(rows)
    empty = spark.createDataFrame([], df.schema)
    assert usercode.keyed_process(empty, ["k"], ["t", "i"], Trace()).collect() == []
    late = spark.createDataFrame([("a", None, 1), ("a", 4, 2)], df.schema)
    assert _set(usercode.keyed_process(late, ["k"], ["t", "i"], Trace())) == _trace([("a", 4, 2)])


def test_keyed_process_stream_equals_closed_batch(spark, folder):
    code = catalog.Sessions(6 * H)
    b = usercode.keyed_process(events(spark, SF_SMALL).select("user_id", "event_type", "ts_ms", "event_id"), ["user_id"], ORDER, code)
    wm = events(spark, SF_SMALL).agg(F.max("ts_ms")).first()[0]
    s = P.apply_keyed_process(_stream(spark, folder), ["user_id"], ORDER, code, ["event_type"])
    got, _ = run_available(s, "q_" + uuid.uuid4().hex[:8], shared_path(spark, "ckpt"))
    assert _set(got) == _set(b.where(F.col("last_ts") + 6 * H < wm)) and got.count() > 100


def test_connected_stream_equals_closed_batch(spark, folder):
    code = catalog.SignupAnswer(48 * H)
    side = F.when(F.col("event_type") == "signup", 0).otherwise(1)
    only = F.col("event_type").isin("signup", "purchase")
    b = usercode.keyed_process(events(spark, SF_SMALL).where(only).withColumn("side", side), ["user_id"], ORDER, code)
    wm = events(spark, SF_SMALL).where(only).agg(F.max("ts_ms")).first()[0]
    s = P.apply_keyed_process(_stream(spark, folder).where(only).withColumn("side", side), ["user_id"], ORDER, code, ["side"])
    got, _ = run_available(s, "q_" + uuid.uuid4().hex[:8], shared_path(spark, "ckpt"))
    closed = set(_set(b.where(F.col("signup_ts") + 48 * H < wm)))
    assert closed <= set(_set(got)) <= set(_set(b)) and len(closed) > 10


def test_connect_keeps_both_sides_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, p string")
    b = spark.createDataFrame([(1, 2.5)], "k int, q double")
    assert {tuple(r) for r in usercode.connect(a, b).select("k", "p", "q", "side").collect()} == {(1, "x", None, 0), (1, None, 2.5, 1)}


class Bag(usercode.UserAggregate):
    output = "n bigint, seen string"

    def create(self):
        return {}

    def add(self, acc, row):
        acc[row["v"]] = acc.get(row["v"], 0) + 1
        return acc

    def merge(self, a, b):
        for k, n in b.items():
            a[k] = a.get(k, 0) + n
        return a

    def result(self, acc):
        return sum(acc.values()), ",".join(f"{k}{n}" for k, n in sorted(acc.items(), key=repr))


@pytest.mark.parametrize("held", [1, 3, 20_000])
@pytest.mark.parametrize("slide", [None, 5])
def test_window_aggregate_against_plain_python(spark, held, slide):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.randint(-30, 200), rng.choice(["x", "y", None])) for _ in range(600)]
    df = spark.createDataFrame(rows + [("a", None, "x")], "k string, t bigint, v string").repartition(6)
    got = usercode.window_aggregate(df, "t", 20, slide, ["k"], Bag(), held=held)
    want, step = {}, slide or 20
    for k, t, v in rows:
        for w in range(t - t % step - 20 + step, t - t % step + 1, step):
            acc = want.setdefault((w, w + 20, k), {})
            acc[v] = acc.get(v, 0) + 1
    assert _set(got) == sorted(((*g, *Bag().result(a)) for g, a in want.items()), key=repr)


def test_window_reduce_and_no_group_in_one_piece(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    code = usercode.WindowReduce("v", max, "largest double")
    got = usercode.window_aggregate(df, "t", 10_000, None, ["k"], code)
    assert _set(got) == [(0, 10_000, "hot", 3999.0)]
    merges = spark.sparkContext.accumulator(0)

    class Counting(usercode.WindowReduce):
        def merge(self, a, b):
            merges.add(1)
            return super().merge(a, b)

    usercode.window_aggregate(df, "t", 10_000, None, ["k"], Counting("v", max, "largest double")).collect()
    assert merges.value == 7                  # eight tasks, eight accumulators


def _join(a, b):
    return (a[0] + b[0],)


@pytest.mark.parametrize("slices", ["2", "40"])
def test_running_reduce_need_not_commute(spark, slices):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.randint(0, 50), i, rng.choice(["p", "q", "r", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t bigint, i bigint, v string").repartition(4)
    spark.conf.set("eventide.ordered.slices", slices)
    try:
        got = usercode.running_reduce(df, ["k"], ["t", "i"], ["v"], _join, ["text"]).select("k", "t", "i", "v", "text")
        everyone = usercode.running_reduce(df, [], ["t", "i"], ["v"], _join, ["text"]).select("i", "text")
        want, all_want, text, total = [], [], {}, ""
        for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
            text[k] = text.get(k, "") + (v or "")
            total += v or ""
            want.append((k, t, i, v, text[k] or None))
            all_want.append((i, total or None))
        assert _set(got) == sorted(want, key=repr)
        assert _set(everyone) == sorted(all_want, key=repr)
    finally:
        spark.conf.unset("eventide.ordered.slices")


def test_running_reduce_spreads_a_hot_key(spark):
    df = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.lit(1).cast("bigint").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = usercode.running_reduce(df, ["k"], ["t"], ["v"], lambda a, b: (a[0] + b[0],), ["n"])
        tasks = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        assert sum(r.n for r in tasks) == 20_000 and len(tasks) > 1
        assert got.where(F.col("n") != F.col("t") + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
