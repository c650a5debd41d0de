"""Golden results on the literal inputs of the original jobs."""

import pytest
from pyspark.sql import functions as F

from eventide.operators import cep, joins, partitioning, relational, rolling
from eventide.sources.tables import from_rows


@pytest.fixture(params=[False, True], ids=["plain", "hot-split"])
def split(request, spark):
    if request.param:
        spark.conf.set("eventide.ordered.slices", "64")
    yield request.param
    spark.conf.unset("eventide.ordered.slices")


KV = [("a", 1), ("a", 3), ("b", 3), ("b", 4)]


def test_rolling_sum_max_min(spark, split):
    df = from_rows(spark, KV, "k string, v int")
    out = {}
    for kind in ("sum", "max", "min", "count"):
        r = rolling.rolling(df, "k", ["seq"], "v", kind, "r").orderBy("seq").collect()
        out[kind] = [(x.k, x.r) for x in r]
    assert out["sum"] == [("a", 1), ("a", 4), ("b", 3), ("b", 7)]
    assert [v for _, v in out["max"]] == [1, 3, 3, 4]
    assert [v for _, v in out["min"]] == [1, 1, 3, 3]
    assert [v for _, v in out["count"]] == [1, 2, 1, 2]


def test_rolling_max_by_first_wins_on_ties(spark, split):
    df = from_rows(spark, [("a", 5, "x"), ("a", 5, "y"), ("a", 7, "z"), ("a", 2, "w")], "k string, v int, tag string")
    r = rolling.rolling_extreme_by(df, "k", ["seq"], "v", ["tag", "v"], "max").orderBy("seq").collect()
    assert [x.best_tag for x in r] == ["x", "x", "z", "z"]
    r = rolling.rolling_extreme_by(df, "k", ["seq"], "v", ["tag", "v"], "min").orderBy("seq").collect()
    assert [x.best_tag for x in r] == ["x", "x", "x", "w"]


def test_rich_map_returns_timestamps(spark):
    rows = [("Mary", "./home", 1000), ("Bob", "./cart", 2000), ("Alice", "./prod?id=1", 5000), ("Cary", "./home", 60000)]
    df = from_rows(spark, rows, "user string, url string, timestamp bigint", seq_col=None)
    opened, closed = [], []
    out = relational.map_with_lifecycle(
        df.select("timestamp"), lambda pdf, ctx: pdf, "timestamp bigint",
        lambda pid: opened.append(pid) or {"pid": pid}, lambda ctx: closed.append(ctx))
    assert sorted(r.timestamp for r in out.collect()) == [1000, 2000, 5000, 60000]


def test_custom_partitioner(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 10)], "value int")
    parted = partitioning.partition_by_expr(df, 2, F.col("value") % 2)
    got = parted.select(F.spark_partition_id().alias("p"), "value").collect()
    by = {0: [], 1: []}
    for r in got:
        by[r.p].append(r.value)
    assert sorted(by[0]) == [2, 4, 6, 8]
    assert sorted(by[1]) == [1, 3, 5, 7, 9]


def test_flat_repeat(spark):
    df = spark.createDataFrame([("Mary", 1), ("Bob", 2), ("Alice", 3)], "user string, ts int")
    out = relational.flat_repeat(df, "user", {"Mary": 1, "Bob": 2}, ["user"]).collect()
    assert sorted(r.user for r in out) == ["Bob", "Bob", "Mary"]


def test_replicate(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    assert partitioning.replicate(df, 3).count() == 6


APP = [("order-1", "app", 1000), ("order-2", "app", 2000)]
THIRD = [("order-1", "third-party", "success", 3000), ("order-3", "third-party", "success", 4000)]


def _reconcile(spark, wait):
    app = spark.createDataFrame(APP, "id string, source string, ts bigint")
    third = spark.createDataFrame(THIRD, "id string, source string, status string, ts bigint")
    return sorted((r.pay_id, r.status) for r in joins.reconcile(app, third, "id", "ts", "ts", wait).collect())


def test_reconcile_wait_5s(spark):
    assert _reconcile(spark, 5000) == [("order-1", "ok"), ("order-2", "missing_third_party"),
                                       ("order-3", "missing_app")]


def test_reconcile_wait_500ms(spark):
    assert _reconcile(spark, 500) == [("order-1", "missing_app"), ("order-1", "missing_third_party"),
                                      ("order-2", "missing_third_party"), ("order-3", "missing_app")]


def test_window_join(spark):
    left = spark.createDataFrame([("a", 1000), ("b", 1000), ("a", 2000), ("b", 2000)], "k string, lts bigint")
    right = spark.createDataFrame([("a", 3000), ("b", 3000), ("a", 4000), ("b", 4000)], "k string, rts bigint")
    out = joins.window_join(left, right, "k", "lts", "rts", 5000).collect()
    assert len(out) == 8
    assert sum(1 for r in out if r.k == "a") == 4
    assert {(r.window_start, r.window_end) for r in out} == {(0, 5000)}


ORDERS = [("Mary", "order-1", 5000), ("Alice", "order-2", 5000), ("Bob", "order-3", 20000),
          ("Alice", "order-4", 20000), ("Cary", "order-5", 51000)]
CLICKS = [("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000), ("Alice", "./prod?id=200", 3500),
          ("Bob", "./prod?id=2", 2500), ("Alice", "./prod?id=300", 36000), ("Bob", "./home", 30000),
          ("Bob", "./prod?id=1", 23000), ("Bob", "./prod?id=3", 33000)]


def test_interval_join(spark):
    o = spark.createDataFrame(ORDERS, "user string, order_id string, ots bigint")
    c = spark.createDataFrame(CLICKS, "user string, url string, cts bigint")
    out = joins.interval_join(o, c, "user", "ots", "cts", -5 * 60_000, 10 * 60_000).collect()
    assert len(out) == 11
    per = {}
    for r in out:
        per[r.order_id] = per.get(r.order_id, 0) + 1
    assert per == {"order-2": 3, "order-4": 3, "order-3": 5}


def test_full_history_join(spark):
    l = spark.createDataFrame([("a", "stream-1", 1000), ("b", "stream-1", 2000)], "k string, ls string, lts bigint")
    r = spark.createDataFrame([("a", "stream-2", 3000), ("b", "stream-2", 4000)], "k string, rs string, rts bigint")
    out = sorted((x.k, x.lts, x.rts) for x in joins.full_history_join(l, r, "k").collect())
    assert out == [("a", 1000, 3000), ("b", 2000, 4000)]


LOGINS = [("user_1", "192.168.0.1", "fail", 2000), ("user_1", "192.168.0.2", "fail", 3000),
          ("user_2", "192.168.1.29", "fail", 4000), ("user_1", "171.56.23.10", "fail", 5000),
          ("user_2", "192.168.1.29", "success", 6000), ("user_2", "192.168.1.29", "fail", 7000),
          ("user_2", "192.168.1.29", "fail", 8000)]


def test_cep_three_fails(spark, split):
    df = from_rows(spark, LOGINS, "user_id string, ip string, event_type string, ts bigint")
    fail = F.col("event_type") == "fail"
    out = cep.strict_sequence(df, "user_id", ["ts", "seq"], [fail] * 3, "ts", ["a", "b", "c"]).collect()
    assert [(r.user_id, r.a, r.b, r.c) for r in out] == [("user_1", 2000, 3000, 5000)]
    out = cep.times_consecutive(df, "user_id", ["ts", "seq"], fail, 3, "ts").collect()
    assert [(r.user_id, r.first_ts, r.last_ts) for r in out] == [("user_1", 2000, 5000)]
    flat = cep.flat_select(df, "user_id", ["ts", "seq"], [fail] * 3, ["ts", "ip"], "ts").collect()
    assert sorted((r.step, r.ts) for r in flat) == [(0, 2000), (1, 3000), (2, 5000)]


ORDER_EVENTS = [("user_1", "order_1", "create", 1000), ("user_2", "order_2", "create", 2000),
                ("user_1", "order_1", "modify", 10000), ("user_1", "order_1", "pay", 60000),
                ("user_2", "order_3", "create", 600000), ("user_2", "order_3", "pay", 1200000)]


def test_cep_order_timeout(spark, split):
    df = from_rows(spark, ORDER_EVENTS, "user_id string, order_id string, event_type string, ts bigint")
    out = cep.followed_by_within(df, "order_id", "ts", "seq", F.col("event_type") == "create",
                                 F.col("event_type") == "pay", 15 * 60_000, ["user_id"]).collect()
    got = sorted((r.order_id, r.status, r.begin_user_id, r.end_ts, r.timeout_ts) for r in out)
    assert got == [("order_1", "matched", "user_1", 60000, None),
                   ("order_2", "timeout", "user_2", None, 2000 + 15 * 60_000),
                   ("order_3", "matched", "user_2", 1200000, None)]


def test_followed_by_deadline_is_strict(spark):
    rows = [("k", "create", 0), ("k", "pay", 1000)]
    df = from_rows(spark, rows, "k string, event_type string, ts bigint")
    out = cep.followed_by_within(df, "k", "ts", "seq", F.col("event_type") == "create",
                                 F.col("event_type") == "pay", 1000).collect()
    assert [r.status for r in out] == ["timeout"]


def test_process_window_user_code_matches_builtin(spark):
    from data_dirs import SF_SMALL
    from eventide.operators import windows
    from eventide.sources.tables import events
    ev = events(spark, SF_SMALL)

    def distinct_users(pdf):
        import pandas as pd
        return pd.DataFrame({"window_start": [pdf["window_start"].iloc[0]],
                             "window_end": [pdf["window_end"].iloc[0]],
                             "uv": [pdf["user_id"].nunique()]})

    got = windows.process_window(ev, "ts_ms", 3_600_000, None, [], distinct_users,
                                 "window_start long, window_end long, uv long")
    exp = windows.distinct_per_window(ev, "ts_ms", 3_600_000, "user_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
