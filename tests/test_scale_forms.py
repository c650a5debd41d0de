"""Sliding distinct counts without window copies, and joins of keys that are
heavy on both sides."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventide.operators import joins, windows


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("slices", ["2", "30"])
def test_sliding_distinct_against_plain_python(spark, seed, slices):
    rng = random.Random(seed)
    rows = [(rng.choice(["k", "l", None]), rng.choice(["hot", "hot", "a", "b", None]), rng.choice([rng.randint(-40, 60), rng.randint(500, 900)]))
            for _ in range(250)]
    df = spark.createDataFrame(rows + [("k", "a", None)], "k string, u string, t bigint")
    spark.conf.set("eventide.ordered.slices", slices)
    try:
        pv, users, keyed = Counter(), {}, {}
        for k, u, t in rows:
            for w in range(t - t % 4 - 16, t - t % 4 + 1, 4):
                pv[w] += 1
                users.setdefault(w, set()).add(u)
                keyed.setdefault((w, k), set()).add(u)
        got = windows.pv_per_uv(df, "t", 20, 4, "u").select("window_start", "window_end", "pv", "uv")
        assert _set(got) == sorted(((w, w + 20, n, len(users[w] - {None})) for w, n in pv.items()), key=repr)
        got = windows.distinct_per_window(df, "t", 20, "u", 4, ["k"]).select("window_start", "window_end", "k", "uv")
        assert _set(got) == sorted(((w, w + 20, k, len(us)) for (w, k), us in keyed.items()), key=repr)
    finally:
        spark.conf.unset("eventide.ordered.slices")


def test_sliding_distinct_copies_no_row_per_window(spark):
    df = spark.range(0, 5_000, 1, 2).select((F.col("id") % 50).alias("u"), F.col("id").alias("t"))
    plan = windows.pv_per_uv(df, "t", 1_000, 10, "u")._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Generate explode(sequence" in line:     # panes alone are copied to their windows
            assert "u#" not in line.split("Generate", 1)[1]
    empty = spark.createDataFrame([], "u long, t long")
    assert windows.pv_per_uv(empty, "t", 1_000, 10, "u").collect() == []


@pytest.fixture()
def plain_shuffles(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("false", "-1", "16")):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("left_rows, right_rows", [(2_000, 3), (3, 2_000), (600, 900)])
def test_join_of_heavy_keys_is_spread(spark, plain_shuffles, left_rows, right_rows):
    left = spark.range(left_rows).select(F.lit("hot").alias("k"), F.col("id").alias("a")) \
        .unionByName(spark.range(50).select(F.col("id").cast("string").alias("k"), F.col("id").alias("a"))) \
        .unionByName(spark.createDataFrame([(None, 1)], "k string, a long"))
    right = spark.range(right_rows).select(F.lit("hot").alias("k"), F.col("id").alias("b")) \
        .unionByName(spark.range(30, 80).select(F.col("id").cast("string").alias("k"), F.col("id").alias("b"))) \
        .unionByName(spark.createDataFrame([(None, 1)], "k string, b long"))
    got = joins.full_history_join(left, right, "k", rows_per_salt=100)
    tasks = {r.p: r.n for r in got.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = left_rows * right_rows
    assert sum(tasks.values()) == total and len(tasks) >= 8 and max(tasks.values()) < total / 3
    want = left.join(right, "k")
    assert got.count() == want.count()
    key = F.xxhash64("k", "a", "b").cast("decimal(38,0)")
    assert got.agg(F.sum(key)).first()[0] == want.agg(F.sum(key)).first()[0]


def test_window_join_of_one_hot_window(spark, plain_shuffles):
    left = spark.range(1_000).select(F.lit(7).alias("k"), (F.col("id") % 10).alias("lt"), F.col("id").alias("a"))
    right = spark.range(700).select(F.lit(7).alias("k"), (F.col("id") % 10).alias("rt"), F.col("id").alias("b"))
    got = joins.window_join(left, right, "k", "lt", "rt", 10, rows_per_salt=100)
    tasks = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in tasks) == 700_000 and len(tasks) >= 8


def test_heavy_keys_are_bounded(spark):
    rows = spark.range(40).select((F.col("id") % 4).alias("k"))
    got = {r.k: (r._a, r._b) for r in joins.heavy_keys(rows, rows.limit(20), ["k"], rows_per_salt=3).collect()}
    assert set(got) == {0, 1, 2, 3} and all(a == 4 and b == 2 for a, b in got.values())
    assert joins.heavy_keys(rows, rows, ["k"], rows_per_salt=100).collect() == []


def _plain_reconcile(rows, wait):
    out = []
    for k in {r[0] for r in rows}:
        pending, timers = None, []

        def report():
            if pending is not None:
                out.append((k, pending[0], None, "missing_third_party") if pending[1] == 0 else (k, None, pending[0], "missing_app"))

        for _, t, side in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:]):
            if any(x < t for x in timers):
                report()
                pending, timers = None, [x for x in timers if x >= t]
            if pending is not None and pending[1] != side:
                out.append((k, *((t, pending[0]) if side == 0 else (pending[0], t)), "ok"))
                pending = None
            else:
                pending = (t, side)
                timers.append(t + wait)
        report()
    return sorted(out, key=repr)


@pytest.mark.parametrize("heavy_rows", [1, 60, 100_000])
@pytest.mark.parametrize("wait", [3, 15])
def test_reconcile_cut_at_gaps(spark, heavy_rows, wait):
    rng = random.Random(wait)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", "c"]), rng.choice([rng.randint(0, 60), rng.randint(100, 2_000)]), rng.randint(0, 1)) for _ in range(400)]
    side = lambda n: spark.createDataFrame([r[:2] for r in rows if r[2] == n], "id string, t bigint")
    got = joins.reconcile(side(0), side(1), "id", "t", "t", wait, heavy_rows=heavy_rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _plain_reconcile(rows, wait)


def test_one_hot_id_is_reconciled_in_several_tasks(spark, plain_shuffles):
    app = spark.range(4_000).select(F.lit("hot").alias("id"), (F.col("id") * 100).alias("t"))
    third = spark.range(4_000).select(F.lit("hot").alias("id"), (F.col("id") * 100 + 7).alias("t"))
    got = joins.reconcile(app, third, "id", "t", "t", 50, heavy_rows=1_000)
    tasks = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in tasks) == 4_000 and len(tasks) >= 8 and max(r.n for r in tasks) < 1_000
    assert got.where("status != 'ok' or third_ts - app_ts != 7").count() == 0
