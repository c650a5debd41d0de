"""Random events against plain-Python per-record models.

Keys are drawn with heavy skew (one key holds about half the rows) and the
hot-key split is forced, so the sliced plans are exercised on every run.
"""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.operators import cep, joins, rolling, stateful
from eventide.plans.bucketing import bucketed_range_join

SETTINGS = dict(max_examples=4, deadline=None, derandomize=True,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


def _events(seed, n=120):
    rnd = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += rnd.randint(1, 40)
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 6)}"
        rows.append((i, key, t, rnd.randint(-5, 5), rnd.choice(["a", "b", "c"])))
    return rows


SCHEMA = "id bigint, k string, t bigint, v bigint, kind string"


@pytest.fixture()
def split(spark):
    spark.conf.set("eventide.ordered.slices", "17")
    yield
    spark.conf.unset("eventide.ordered.slices")


def _by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


@given(st.integers(0, 10_000))
@settings(**SETTINGS)
def test_running_aggregates_match_model(spark, split, seed):
    rows = _events(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = {}
    for k, rs in _by_key(rows).items():
        s, mx, mn, best = 0, None, None, None
        for n, r in enumerate(rs, 1):
            s += r[3]
            mx = r[3] if mx is None else max(mx, r[3])
            mn = r[3] if mn is None else min(mn, r[3])
            if best is None or r[3] > best[3]:
                best = r                      # first wins on ties
            expected[r[0]] = (s, mx, mn, n, best[0])
    from eventide.plans.ordered import running
    out = running(df, ["k"], ["t", "id"], {"s": ("sum", F.col("v")), "mx": ("max", F.col("v")),
                                           "mn": ("min", F.col("v")), "n": ("count", F.lit(1))})
    out = rolling.rolling_extreme_by(out, "k", ["t", "id"], "v", ["id"], "max")
    got = {r.id: (r.s, r.mx, r.mn, r.n, r.best_id) for r in out.collect()}
    assert got == expected


@given(st.integers(0, 10_000), st.integers(-80, 60), st.integers(0, 90))
@settings(**SETTINGS)
def test_bucketed_range_join_matches_brute_force(spark, seed, lower, width):
    # intervals before, around and after the left time, zero width included
    upper = lower + width
    rows = _events(seed, 80)
    left = spark.createDataFrame([(r[1], r[0], r[2]) for r in rows if r[4] == "a"], "k string, lid bigint, lt bigint")
    right = spark.createDataFrame([(r[1], r[0], r[2]) for r in rows if r[4] != "a"], "k string, rid bigint, rt bigint")
    got = sorted((r.lid, r.rid) for r in bucketed_range_join(left, right, ["k"], "lt", "rt", lower, upper).collect())
    exp = sorted((a[0], b[0]) for a in rows if a[4] == "a" for b in rows
                 if b[4] != "a" and a[1] == b[1] and a[2] + lower <= b[2] <= a[2] + upper)
    assert got == exp


def _periodic_model(rows, period):
    out = []
    for k, rs in _by_key(rows).items():
        count, armed = 0, None
        for r in rs:
            if armed is not None and r[2] > armed:
                out.append((k, armed, count))
                armed = None
            count += 1
            if armed is None:
                armed = r[2] + period
        if armed is not None:
            out.append((k, armed, count))     # end of input fires the last timer
    return sorted(out)


@given(st.integers(0, 10_000), st.integers(1, 200))
@settings(**SETTINGS)
def test_periodic_counts_match_per_record_model(spark, seed, period):
    rows = _events(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in stateful.periodic_counts(df, "k", "t", period).collect())
    assert got == _periodic_model(rows, period)


@given(st.integers(0, 10_000), st.integers(1, 150))
@settings(**SETTINGS)
def test_followed_by_matches_model(spark, split, seed, within):
    rows = _events(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    out = cep.followed_by_within(df, "k", "t", "id", F.col("kind") == "a", F.col("kind") == "b", within)
    got = sorted((r.k, r.begin_ts, r.end_ts, r.status) for r in out.collect())
    exp = []
    for k, rs in _by_key(rows).items():
        for i, r in enumerate(rs):
            if r[4] != "a":
                continue
            nxt = next((x for x in rs[i + 1:] if x[4] == "b"), None)
            if nxt is not None and nxt[2] - r[2] < within:
                exp.append((k, r[2], nxt[2], "matched"))
            else:
                exp.append((k, r[2], None, "timeout"))
    assert got == sorted(exp)


@given(st.integers(0, 10_000), st.integers(2, 4))
@settings(**SETTINGS)
def test_strict_sequence_matches_model(spark, split, seed, n):
    rows = _events(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    out = cep.times_consecutive(df, "k", ["t", "id"], F.col("kind") != "c", n, "t")
    got = sorted((r.k, r.first_ts, r.last_ts) for r in out.collect())
    exp = []
    for k, rs in _by_key(rows).items():
        for i in range(len(rs) - n + 1):
            if all(x[4] != "c" for x in rs[i:i + n]):
                exp.append((k, rs[i][2], rs[i + n - 1][2]))
    assert got == sorted(exp)


@given(st.integers(0, 10_000))
@settings(**SETTINGS)
def test_global_order_buffer_and_most_active(spark, split, seed):
    rows = _events(seed, 95)
    df = spark.createDataFrame(rows, SCHEMA)
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    got = sorted((r.batch_no, r.pos, r.id) for r in stateful.buffered_batches(df, ["t", "id"], 10).collect())
    exp = sorted((i // 10, i % 10 + 1, r[0]) for i, r in enumerate(order) if i < 90)
    assert got == exp
    counts, top, exp_top = {}, None, {}
    for r in order:
        counts[r[1]] = counts.get(r[1], 0) + 1
        if top is None or counts[r[1]] >= top[1]:   # later record wins ties
            top = (r[1], counts[r[1]])
        exp_top[r[0]] = top
    out = rolling.most_active_so_far(df.select("id", "k", "t"), "k", ["t", "id"])
    assert {r.id: (r.top_user, r.top_count) for r in out.collect()} == exp_top


def _slices(spark, rows, order=("t", "id")):
    from eventide.plans.ordered import slice_column
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("s", slice_column(df, list(order), 20)).collect()


def test_slices_are_even_for_hot_null_keys_outliers_and_hot_times(spark):
    """No key, no outlier and no single time decides how many rows a slice holds."""
    cases = {"null key": [(i, None, i, 0, "a") for i in range(2000)],
             "outlier": [(0, "k", -10**12, 0, "a")] + [(i, "k", 10**9 + i, 0, "a") for i in range(1, 2000)],
             "20 hot keys": [(i, f"k{i % 20}", i // 20, 0, "a") for i in range(2000)],
             "one time": [(i, "k", 5 if i % 2 else i, 0, "a") for i in range(2000)]}
    for name, rows in cases.items():
        got = _slices(spark, rows)
        sizes = {}
        for r in got:
            sizes[r.s] = sizes.get(r.s, 0) + 1
        assert max(sizes.values()) <= 2.5 * 2000 / 20, (name, sizes)
        order = sorted(got, key=lambda r: (r.t, r.id))
        assert [r.s for r in order] == sorted(r.s for r in order)


def test_running_with_null_hot_key_ties_and_null_times(spark, split):
    from eventide.plans.ordered import running
    rows = [(i, None if i % 3 else "x", None if i < 5 else 7 if i % 2 else i, i % 4, "a") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = running(df, ["k"], ["t", "id"], {"s": ("sum", F.col("v")), "n": ("count", F.lit(1))})
    exp, acc = {}, {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        s, n = acc.get(r[1], (0, 0))
        acc[r[1]] = exp[r[0]] = (s + r[3], n + 1)
    assert {r.id: (r.s, r.n) for r in out.collect()} == exp


def test_no_single_partition_in_global_orders(spark):
    df = spark.createDataFrame(_events(3), SCHEMA)
    for out in (rolling.most_active_so_far(df.select("id", "k", "t"), "k", ["t", "id"]),
                stateful.buffered_batches(df, ["t", "id"], 10)):
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_extremes_ignore_nulls_and_take_any_type(spark, split):
    rows = [("a", 1, "id9", None), ("a", 2, "id8", 5.5), ("a", 3, "id7", 3.25), ("a", 4, "id6", 3.25), ("b", 1, "x", None)]
    df = spark.createDataFrame(rows, "k string, t bigint, id string, v double")
    got = {(r.k, r.t): (r.best_v, r.best_id) for r in rolling.rolling_extreme_by(df, "k", ["t", "id"], "v", ["v", "id"], "min").collect()}
    assert got == {("a", 1): (None, None), ("a", 2): (5.5, "id8"), ("a", 3): (3.25, "id7"), ("a", 4): (3.25, "id7"), ("b", 1): (None, None)}
    text = rolling.rolling_extreme_by(df, "k", ["t", "id"], "id", ["id"], "max").collect()
    assert {r.best_id for r in text if r.k == "a"} == {"id9"}


def test_periodic_counts_share_a_hot_key_between_tasks(spark, split):
    rows = [(i, "hot" if i % 2 else f"k{i % 7}", i * 3, 0, "a") for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    from eventide.plans.ordered import slice_column
    used = df.where("k = 'hot'").select(slice_column(df, ["t"]).alias("s")).distinct().count()
    assert used >= 10
    for period in (1, 50, 700, 10_000):
        got = sorted(tuple(r) for r in stateful.periodic_counts(df, "k", "t", period).collect())
        assert got == _periodic_model(rows, period)


def _reconcile_model(rows, wait):
    out = []
    for k in {r[0] for r in rows}:
        pending, timers = None, []

        def report():
            if pending:
                out.append((k, pending[0], None, "missing_third_party") if pending[1] == 0 else (k, None, pending[0], "missing_app"))
        for _, t, s in sorted(r for r in rows if r[0] == k):
            if any(x < t for x in timers):
                report()
                pending, timers = None, [x for x in timers if x >= t]
            if pending and pending[1] != s:
                out.append((k, *((t, pending[0]) if s == 0 else (pending[0], t)), "ok"))
                pending = None
            else:
                pending = (t, s)
                timers.append(t + wait)
        report()
    return sorted(out, key=repr)


@given(st.integers(0, 10_000), st.integers(1, 60))
@settings(**SETTINGS)
def test_reconcile_overwrites_and_consumes_repeated_ids(spark, seed, wait):
    rnd = random.Random(seed)
    rows = [(f"p{rnd.randint(0, 12)}", rnd.randint(0, 200), rnd.randint(0, 1)) for _ in range(90)]
    app = spark.createDataFrame([r[:2] for r in rows if r[2] == 0] + [(None, 7)], "id string, t bigint")
    third = spark.createDataFrame([r[:2] for r in rows if r[2] == 1] + [(None, 7)], "id string, t bigint")
    got = sorted((tuple(r) for r in joins.reconcile(app, third, "id", "t", "t", wait).collect() if r.pay_id), key=repr)
    assert got == _reconcile_model(rows, wait)
    alone = [tuple(r) for r in joins.reconcile(app, third, "id", "t", "t", wait).collect() if r.pay_id is None]
    assert sorted(alone, key=repr) == [(None, 7, None, "missing_third_party"), (None, None, 7, "missing_app")]


def test_two_events_a_side_do_not_multiply(spark):
    app = spark.createDataFrame([("p", 1), ("p", 2)], "id string, t bigint")
    third = spark.createDataFrame([("p", 3), ("p", 4)], "id string, t bigint")
    got = sorted(r.status for r in joins.reconcile(app, third, "id", "t", "t", 100).collect())
    assert got == ["missing_app", "ok"]


def test_salted_join_spreads_a_hot_key(spark):
    rows = _events(11, 150)
    left = spark.createDataFrame([(r[1], r[0]) for r in rows] + [(None, -1)], "k string, lid bigint")
    right = spark.createDataFrame([(r[1], r[0]) for r in rows] + [(None, -1)], "k string, rid bigint")
    exp = sorted((a[1], a[0], b[0]) for a in rows for b in rows if a[1] == b[1])
    for size in (1, 10, 1000):
        out = joins.full_history_join(left, right, "k", rows_per_salt=size)
        assert sorted((r.k, r.lid, r.rid) for r in out.collect()) == exp
        assert "_salt" in out._jdf.queryExecution().optimizedPlan().toString()


def test_accumulators_in_panes_equal_plain_windows(spark):
    from eventide.operators import windows
    rows = [(r[0], r[1], r[2] * 100 - 3000, r[3]) for r in _events(13)] + [(999, "k1", None, 5)]
    df = spark.createDataFrame(rows, "id bigint, k string, t bigint, v bigint")
    acc = {"s": ("sum", F.col("v")), "n": ("count", F.col("v")), "last": ("max", F.struct("t", "id", "v"))}
    res = {"avg": F.col("s") / F.col("n"), "latest": F.col("last.v"), "n": F.col("n")}
    paned = windows.accumulate(df, "t", 3000, 1000, ["k"], acc, res)
    stamped = df.withColumn("ts", F.timestamp_millis("t"))  # a timestamp: the plain windows
    plain = windows.accumulate(stamped, "ts", 3000, 1000, ["k"], acc, res)
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(key, paned.collect())) == sorted(map(key, plain.collect())) != []
