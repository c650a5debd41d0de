"""Streaming forms checked against the batch forms.

The stream reads the ``events`` table split into time-ordered files, one
file per micro-batch.  A stream closes windows, timers and partial matches
only up to its final watermark, so it is compared with the part of the
batch answer that the watermark has closed (the batch is the bounded run,
where every timer fires at end of input).
"""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from data_dirs import SF_SMALL
from eventide.operators import cep, joins, stateful, topn, windows
from eventide.session import shared_path
from eventide.sources.streams import event_stream
from eventide.sources.tables import events
from eventide.streaming import processors as P
from eventide.streaming import streams as S
from eventide.streaming.run import run_available, run_foreach_batch
from streamutil import split_by_time

H = 3_600_000
ORDER = ["ts_ms", "event_id"]


@pytest.fixture(scope="module")
def folder(spark):
    path = shared_path(spark, "events-stream")
    schema = split_by_time(spark, os.path.join(SF_SMALL, "events.parquet"), path, 4)
    return path, schema


def _stream(spark, folder, delay_ms=0):
    path, schema = folder
    s = event_stream(spark, path, schema, max_files_per_trigger=1)
    s = s.select("event_id", "user_id", "event_type", "value", "ts_ms", "event_time")
    return S.watermarked(s, "ts_ms", delay_ms)


def _batch(spark):
    return events(spark, SF_SMALL)


def _max_ts(spark):
    return _batch(spark).agg(F.max("ts_ms")).first()[0]


def _run(spark, df, mode="append"):
    name = "q_" + uuid.uuid4().hex[:8]
    out, q = run_available(df, name, shared_path(spark, "ckpt"), mode)
    return out, q


def _set(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_tumbling_count_stream_equals_closed_batch(spark, folder):
    st, _ = _run(spark, windows.count_per_window(_stream(spark, folder), "event_time", H, keys=["user_id"]))
    wm = _max_ts(spark)
    b = windows.count_per_window(_batch(spark), "ts_ms", H, keys=["user_id"]).where(F.col("window_end") <= wm)
    cols = ["window_start", "window_end", "user_id", "cnt"]
    assert _set(st, cols) == _set(b, cols)
    assert st.count() > 0


def test_sliding_distinct_stream(spark, folder):
    st, _ = _run(spark, windows.pv_per_uv(_stream(spark, folder), "event_time", 5 * H, H, "user_id"))
    wm = _max_ts(spark)
    b = windows.pv_per_uv(_batch(spark), "ts_ms", 5 * H, H, "user_id").where(F.col("window_end") <= wm)
    cols = ["window_start", "window_end", "pv", "uv"]
    assert _set(st, cols) == _set(b, cols)


def test_top_n_stream_equals_closed_batch(spark, folder):
    st, _ = _run(spark, S.top_n_stream(_stream(spark, folder), "event_time", "event_type", 2 * H, H, 2))
    wm = _max_ts(spark)
    b = topn.top_n_per_window(_batch(spark), "ts_ms", "event_type", 2 * H, H, 2).where(F.col("window_end") <= wm)
    cols = ["window_start", "window_end", "event_type", "cnt", "rank"]
    assert _set(st, cols) == _set(b, cols)
    assert st.count() > 0


def _sides(df, kind, prefix, keep_time=True):
    cols = [F.col("user_id"), F.col("event_id").alias(f"{prefix}_event_id"), F.col("ts_ms").alias(f"{prefix}_ts_ms")]
    if keep_time:
        cols.append(F.col("event_time").alias(f"{prefix}_time"))
    return df.where(F.col("event_type") == kind).select(*cols)


def test_window_join_stream_equals_batch(spark, folder):
    s = _stream(spark, folder)
    st, _ = _run(spark, S.window_join_stream(_sides(s, "purchase", "p"), _sides(s, "view", "v"),
                                             "user_id", "p_time", "v_time", 5 * H))
    b = _batch(spark)
    bj = joins.window_join(_sides(b, "purchase", "p", False), _sides(b, "view", "v", False),
                           "user_id", "p_ts_ms", "v_ts_ms", 5 * H)
    cols = ["user_id", "window_start", "p_event_id", "v_event_id"]
    assert _set(st, cols) == _set(bj, cols)


def test_interval_join_stream_equals_batch(spark, folder):
    s = _stream(spark, folder)
    st, _ = _run(spark, S.interval_join_stream(_sides(s, "purchase", "p"), _sides(s, "view", "v"), "user_id",
                                               "p_time", "v_time", -6 * H, 12 * H, "p_ts_ms", "v_ts_ms"))
    b = _batch(spark)
    bj = joins.interval_join(_sides(b, "purchase", "p", False), _sides(b, "view", "v", False),
                             "user_id", "p_ts_ms", "v_ts_ms", -6 * H, 12 * H)
    cols = ["user_id", "p_event_id", "v_event_id"]
    assert _set(st, cols) == _set(bj, cols)
    assert st.count() > 0


def test_full_history_join_stream_equals_batch(spark, folder):
    s = _stream(spark, folder)
    st, _ = _run(spark, S.full_history_join_stream(_sides(s, "purchase", "p"), _sides(s, "signup", "g"), "user_id"))
    b = _batch(spark)
    bj = joins.full_history_join(_sides(b, "purchase", "p", False), _sides(b, "signup", "g", False), "user_id")
    cols = ["user_id", "p_event_id", "g_event_id"]
    assert _set(st, cols) == _set(bj, cols)


def test_reconcile_stream_closed_part(spark, folder):
    def sides(df, with_time):
        # one event per id and side, as the join form assumes
        cols = [F.floor(F.col("event_id") / 2).alias("id"), "ts_ms"] + (["event_time"] if with_time else [])
        return df.where("event_id % 2 = 0").select(*cols), df.where("event_id % 2 = 1").select(*cols)
    app, third = sides(_stream(spark, folder), True)
    st, _ = _run(spark, S.reconcile_stream(app, third, "id", "event_time", "event_time", H))
    ba, bt = sides(_batch(spark), False)
    b = joins.reconcile(ba, bt, "id", "ts_ms", "ts_ms", H)
    cols = ["pay_id", "app_ts", "third_ts", "status"]
    got, exp = set(_set(st, cols)), set(_set(b, cols))
    wm = _max_ts(spark)
    assert got <= exp
    assert {r for r in exp if r[3] == "ok"} <= got
    closed = {r for r in exp if r[3] != "ok" and (r[1] if r[1] is not None else r[2]) + H < wm}
    assert closed <= got


def test_periodic_count_stream_closed_part(spark, folder):
    s = _stream(spark, folder)
    st, _ = _run(spark, P.apply_periodic_count(s.select("user_id", "ts_ms", "event_time"), "user_id", "ts_ms", 10 * H))
    b = stateful.periodic_counts(_batch(spark), "user_id", "ts_ms", 10 * H)
    wm = _max_ts(spark)
    got = set(_set(st, ["user_id", "fire_ts", "pv"]))
    exp = set(_set(b, ["user_id", "fire_ts", "pv"]))
    assert got <= exp
    assert {r for r in exp if r[1] < wm} <= got


def test_count_window_avg_stream_equals_batch(spark, folder):
    s = _stream(spark, folder)
    st, _ = _run(spark, P.apply_count_window_avg(s, "user_id", "ts_ms", ORDER, 5))
    b = stateful.count_window_avg(_batch(spark), "user_id", ORDER, "ts_ms", 5)
    cols = ["user_id", "window_no", "avg_ts"]
    assert _set(st, cols) == _set(b, cols)
    st, _ = _run(spark, P.apply_count_window_avg(s, "user_id", "ts_ms", ORDER, 6, repeat=False))
    b = stateful.nth_event_avg(_batch(spark), "user_id", ORDER, "ts_ms", 6)
    assert _set(st, ["user_id", "avg_ts"]) == _set(b, ["user_id", "avg_ts"])


def test_buffer_stream_equals_batch_and_survives_restart(spark, folder):
    path, schema = folder
    fields = ["event_id", "user_id", "ts_ms"]
    ckpt = shared_path(spark, "buffer-ckpt")
    name = "buf_" + uuid.uuid4().hex[:8]
    out_dir = shared_path(spark, "buffer-out")

    def writer(batch, batch_id):
        batch.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))

    def stream(max_files):
        s = event_stream(spark, path, schema, max_files_per_trigger=1)
        return P.apply_buffer(s.select(*fields, "ts_ms"), 10, fields, ORDER, shards=1)

    # first run: stop after two files, then restart on the same checkpoint
    q = (stream(1).writeStream.foreachBatch(writer).option("checkpointLocation", ckpt)
         .trigger(processingTime="0 seconds").start())
    import time
    deadline = time.time() + 120
    while time.time() < deadline and len(q.recentProgress) < 2:
        time.sleep(0.5)
    q.stop()
    run_foreach_batch(stream(1), writer, ckpt)
    got = spark.read.parquet(out_dir)
    b = stateful.buffered_batches(_batch(spark).select(*fields), ORDER, 10)
    assert _set(got, ["batch_no", "pos", "event_id"]) == _set(b, ["batch_no", "pos", "event_id"])


def test_strict_sequence_stream_equals_batch(spark, folder):
    s = _stream(spark, folder)
    err = F.col("event_type") == "error"
    names = ["first_ts", "second_ts", "third_ts"]
    st, _ = _run(spark, P.apply_strict_sequence(s, "user_id", [err] * 3, "ts_ms", ORDER, names))
    b = cep.strict_sequence(_batch(spark), "user_id", ORDER, [err] * 3, "ts_ms", names)
    cols = ["user_id"] + names
    assert _set(st, cols) == _set(b, cols)
    assert st.count() > 0


def test_followed_by_stream_closed_part(spark, folder):
    s = _stream(spark, folder)
    begin, end = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    st, _ = _run(spark, P.apply_followed_by(s, "user_id", "ts_ms", "event_id", begin, end, 24 * H))
    b = cep.followed_by_within(_batch(spark), "user_id", "ts_ms", "event_id", begin, end, 24 * H,
                               ["event_id"], ["event_id"])
    cols = ["user_id", "begin_ts", "end_ts", "status"]
    got, exp = set(_set(st, cols)), set(_set(b, cols))
    wm = _max_ts(spark)
    assert got <= exp
    closed = {r for r in exp if r[3] == "matched" or r[1] + 24 * H <= wm}
    assert closed <= got


def test_rolling_changelog_stream_equals_batch(spark, folder):
    from eventide.operators import rolling
    s = _stream(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    st, _ = _run(spark, P.apply_rolling(s, "user_id", "sum", "cents", ORDER, "event_id", "running_sum"))
    b = _batch(spark).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    br = rolling.rolling(b, "user_id", ORDER, "cents", "sum", "running_sum")
    cols = ["user_id", "event_id", "running_sum"]
    assert _set(st, cols) == _set(br, cols)


def test_reconcile_processor_fixture(spark, scratch):
    rows = [("order-1", 1000, "app"), ("order-2", 2000, "app"),
            ("order-1", 3000, "third"), ("order-3", 4000, "third")]
    folder = os.path.join(scratch, "pay")
    spark.createDataFrame(rows, "id string, ts bigint, side string").coalesce(1).write.parquet(folder)
    s = spark.readStream.schema("id string, ts bigint, side string").parquet(folder)
    s = S.watermarked(s, "ts", 0)
    app = s.where(F.col("side") == "app")
    third = s.where(F.col("side") == "third")
    st, _ = _run(spark, P.apply_reconcile(app, third, "id", "ts", "ts", 5000))
    got = sorted((r.pay_id, r.status) for r in st.collect())
    # order-1 matched; order-2's timer (7000) is past the final watermark
    # (4000) and stays armed; so does order-3's (9000)
    assert got == [("order-1", "ok")]


def test_sql_over_stream(spark, folder):
    from eventide.operators.relational import sql_over
    s = _stream(spark, folder)
    st, _ = _run(spark, sql_over(s, "clicks_stream", "SELECT event_type, user_id FROM {clicks_stream}"))
    assert st.count() == _batch(spark).count()


def test_text_file_sink_stream(spark, folder, scratch):
    from eventide.operators.relational import record_text_col
    from eventide.operators.sinks import text_stream_sink
    s = _stream(spark, folder).select(record_text_col("Event", ["user_id", "event_type", "ts_ms"]).alias("value"))
    out = os.path.join(scratch, "text")
    q = text_stream_sink(s, out, os.path.join(scratch, "ck"), roll_interval="0 seconds",
                         max_records_per_file=100).trigger(availableNow=True).start()
    q.awaitTermination(300)
    lines = spark.read.text(out)
    assert lines.count() == _batch(spark).count()
    assert lines.first().value.startswith("Event(")


def test_late_rows_dropped_by_window(spark, scratch):
    """Out-of-order files (tumbling 5 s, watermark delay 0):
    1000 20000 | 2000 | 3000 40000 | 4000 21000 | 60000."""
    folder = os.path.join(scratch, "late")
    files = [[1000, 20000], [2000], [3000, 40000], [4000, 21000], [60000]]
    for ts in files:
        spark.createDataFrame([("u", "x", t) for t in ts], "user string, url string, timestamp bigint") \
            .coalesce(1).write.mode("append").parquet(folder)
    s = event_stream(spark, folder, "user string, url string, timestamp bigint", ts_col="timestamp",
                     max_files_per_trigger=1)
    s = S.watermarked(s, "ts_ms", 0)
    st, _ = _run(spark, windows.count_per_window(s, "event_time", 5000))
    got = sorted((r.window_start, r.cnt) for r in st.collect())
    assert got == [(0, 2), (20000, 2), (40000, 1)]


def test_most_active_user_stream_equals_batch(spark, folder, scratch):
    from eventide.operators import rolling
    from eventide.streaming.global_order import most_active_writer
    s = _stream(spark, folder).select("event_id", "user_id", "ts_ms")
    changelog = P.apply_rolling(s, "user_id", "count", None, ORDER, "event_id", "user_count")
    out = os.path.join(scratch, "top")
    run_foreach_batch(changelog, most_active_writer(out, os.path.join(scratch, "top-state"),
                                                    "user_id", "user_count", ORDER),
                      shared_path(spark, "ckpt"))
    got = spark.read.parquet(out)
    b = rolling.most_active_so_far(_batch(spark).select("event_id", "user_id", "ts_ms"), "user_id", ORDER)
    cols = ["event_id", "user_count", "top_user", "top_count"]
    assert _set(got, cols) == _set(b, cols)


def test_timeouts_to_side_output(spark, folder, scratch):
    from eventide.streaming.global_order import side_output_writer
    s = _stream(spark, folder)
    begin, end = F.col("event_type") == "signup", F.col("event_type") == "purchase"
    matches = P.apply_followed_by(s, "user_id", "ts_ms", "event_id", begin, end, 24 * H)

    def to(path):
        return lambda b, i: b.write.mode("overwrite").parquet(os.path.join(scratch, path, f"batch={i}"))

    run_foreach_batch(matches, side_output_writer("status = 'timeout'", to("main"), to("side")),
                      shared_path(spark, "ckpt"))
    main = spark.read.parquet(os.path.join(scratch, "main"))
    side = spark.read.parquet(os.path.join(scratch, "side"))
    assert main.count() > 0 and side.count() > 0
    assert {r.status for r in main.collect()} == {"matched"}
    assert {r.status for r in side.collect()} == {"timeout"}


def test_reconcile_processor_overwrite_and_stale_timer(spark, scratch):
    """A second app event overwrites the pending one; the first event's timer
    is not cancelled and reports the newer pending event when it fires."""
    rows = [("p1", 1000, "app"), ("p1", 3000, "app"), ("zz", 20000, "third")]
    folder = os.path.join(scratch, "pay2")
    spark.createDataFrame(rows, "id string, ts bigint, side string").coalesce(1).write.parquet(folder)
    s = S.watermarked(spark.readStream.schema("id string, ts bigint, side string").parquet(folder), "ts", 0)
    st, _ = _run(spark, P.apply_reconcile(s.where(F.col("side") == "app"), s.where(F.col("side") == "third"),
                                          "id", "ts", "ts", 5000))
    got = sorted((r.pay_id, r.app_ts, r.third_ts, r.status) for r in st.collect())
    assert got == [("p1", 3000, None, "missing_third_party")]


def test_sharded_buffer_releases_full_batches(spark, folder):
    fields = ["event_id", "user_id", "ts_ms"]
    s = _stream(spark, folder).select(*fields)
    st, _ = _run(spark, P.apply_buffer(s, 10, fields, ORDER, shards=4))
    rows = st.collect()
    per = {}
    for r in rows:
        per.setdefault((r.shard, r.batch_no), []).append(r.event_id)
    assert {r.shard for r in rows} == {0, 1, 2, 3}
    assert all(len(v) == 10 for v in per.values())
    assert len({r.event_id for r in rows}) == len(rows) > 1000 - 4 * 10


def _run_with_restart(spark, make_stream, out_dir, ckpt, stop_after=2):
    """Run until ``stop_after`` micro-batches completed, stop, then resume on
    the same checkpoint until all input is processed."""
    import time

    def writer(batch, batch_id):
        batch.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch={batch_id}"))

    q = (make_stream().writeStream.foreachBatch(writer).option("checkpointLocation", ckpt)
         .trigger(processingTime="0 seconds").start())
    deadline = time.time() + 120
    while time.time() < deadline and len([p for p in q.recentProgress if p["numInputRows"] > 0]) < stop_after:
        time.sleep(0.3)
    q.stop()
    run_foreach_batch(make_stream(), writer, ckpt)
    return spark.read.parquet(out_dir)


@pytest.mark.parametrize("op", ["periodic", "followed_by"])
def test_stateful_operator_survives_restart(spark, folder, op):
    def make():
        s = _stream(spark, folder)
        if op == "periodic":
            return P.apply_periodic_count(s.select("user_id", "ts_ms", "event_time"), "user_id", "ts_ms", 10 * H)
        return P.apply_followed_by(s, "user_id", "ts_ms", "event_id", F.col("event_type") == "signup",
                                   F.col("event_type") == "purchase", 24 * H)
    cols = ["user_id", "fire_ts", "pv"] if op == "periodic" else ["user_id", "begin_ts", "end_ts", "status"]
    restarted = _run_with_restart(spark, make, shared_path(spark, "out"), shared_path(spark, "ckpt"))
    straight, _ = _run(spark, make())
    assert _set(restarted, cols) == _set(straight, cols)
    assert restarted.count() > 0


def test_flat_select_stream_equals_batch(spark, folder):
    err = F.col("event_type") == "error"
    st, _ = _run(spark, P.apply_strict_sequence_flat(_stream(spark, folder), "user_id", [err] * 3, "ts_ms", ORDER))
    b = cep.flat_select(_batch(spark), "user_id", ORDER, [err] * 3, ["ts_ms"], "ts_ms")
    assert _set(st, ["user_id", "match_ts", "step", "ts"]) == _set(b.withColumnRenamed("ts_ms", "ts"),
                                                                    ["user_id", "match_ts", "step", "ts"])
    assert st.count() > 0


@pytest.mark.parametrize("kind", ["max", "min"])
def test_rolling_extreme_by_stream_equals_batch(spark, folder, kind):
    from eventide.operators import rolling
    s = _stream(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    st, _ = _run(spark, P.apply_rolling_extreme_by(s, "user_id", kind, "cents", ORDER, "event_id"))
    b = _batch(spark).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    br = rolling.rolling_extreme_by(b, "user_id", ORDER, "cents", ["event_id", "cents"], kind)
    got = _set(st, ["event_id", "best_id", "best_value"])
    exp = _set(br, ["event_id", "best_event_id", "best_cents"])
    assert got == exp and len(got) == 1000


def test_late_rows_strict_filter(spark, scratch):
    """Same files with the late-row filter on the current watermark
    (``statefulOperator.allowMultiple=false``): one row per window."""
    folder = os.path.join(scratch, "late2")
    for ts in [[1000, 20000], [2000], [3000, 40000], [4000, 21000], [60000]]:
        spark.createDataFrame([("u", "x", t) for t in ts], "user string, url string, timestamp bigint") \
            .coalesce(1).write.mode("append").parquet(folder)
    conf = "spark.sql.streaming.statefulOperator.allowMultiple"
    spark.conf.set(conf, "false")
    try:
        s = event_stream(spark, folder, "user string, url string, timestamp bigint", ts_col="timestamp",
                         max_files_per_trigger=1)
        st, _ = _run(spark, windows.count_per_window(S.watermarked(s, "ts_ms", 0), "event_time", 5000))
        got = sorted((r.window_start, r.cnt) for r in st.collect())
    finally:
        spark.conf.unset(conf)
    assert got == [(0, 1), (20000, 1), (40000, 1)]


def test_five_second_delay_keeps_rows_that_are_less_late(spark, scratch):
    """Bounded out-of-orderness of 5 s: 4000 after 6000 still counts, 4500
    after 12000 does not, 8000 after 12000 does."""
    folder = os.path.join(scratch, "delay5")
    for ts in [[1000, 6000], [4000], [12000], [4500, 8000], [30000]]:
        spark.createDataFrame([("u", "x", t) for t in ts], "user string, url string, timestamp bigint") \
            .coalesce(1).write.mode("append").parquet(folder)
    conf = "spark.sql.streaming.statefulOperator.allowMultiple"
    spark.conf.set(conf, "false")
    try:
        s = event_stream(spark, folder, "user string, url string, timestamp bigint", ts_col="timestamp",
                         max_files_per_trigger=1)
        st, _ = _run(spark, windows.count_per_window(S.watermarked(s, "ts_ms", 5000), "event_time", 5000))
        got = sorted((r.window_start, r.cnt) for r in st.collect())
    finally:
        spark.conf.unset(conf)
    assert got == [(0, 2), (5000, 2), (10000, 1)]


@pytest.mark.parametrize("kind,expected", [("sum", [None, 1.5, 0.75, 0.75, 3.0]), ("max", [None, 1.5, 1.5, 1.5, 2.25]),
                                           ("min", [None, 1.5, -0.75, -0.75, -0.75])])
def test_rolling_stream_keeps_fractions_and_skips_nulls(spark, scratch, kind, expected):
    folder = os.path.join(scratch, "doubles")
    for part in ([(1, None), (2, 1.5)], [(3, -0.75), (4, None), (5, 2.25)]):
        spark.createDataFrame([("u", i, i * 1000, v) for i, v in part], "k string, id bigint, timestamp bigint, v double") \
            .coalesce(1).write.mode("append").parquet(folder)
    s = event_stream(spark, folder, "k string, id bigint, timestamp bigint, v double", ts_col="timestamp", max_files_per_trigger=1)
    st, _ = _run(spark, P.apply_rolling(s, "k", kind, "v", ["ts_ms", "id"], "id", "r"))
    assert [r.r for r in st.orderBy("id").collect()] == expected
    if kind != "sum":
        s = event_stream(spark, folder, "k string, id bigint, timestamp bigint, v double", ts_col="timestamp", max_files_per_trigger=1)
        st, _ = _run(spark, P.apply_rolling_extreme_by(s, "k", kind, "v", ["ts_ms", "id"], "id"))
        assert [r.best_value for r in st.orderBy("id").collect()] == expected


def test_reconcile_stream_equals_batch_on_repeats(spark, scratch):
    rows = [("app", "p", 1000), ("app", "p", 2000), ("third", "p", 3000), ("third", "p", 9000), ("app", "q", 1000),
            ("third", "q", 20000), ("app", "z", 90000)]
    folder = os.path.join(scratch, "repeats")
    for part in (rows[:3], rows[3:5], rows[5:]):
        spark.createDataFrame(part, "side string, id string, timestamp bigint").coalesce(1).write.mode("append").parquet(folder)
    s = S.watermarked(event_stream(spark, folder, "side string, id string, timestamp bigint", ts_col="timestamp",
                                   max_files_per_trigger=1), "ts_ms", 0)
    st, _ = _run(spark, P.apply_reconcile(s.where("side = 'app'"), s.where("side = 'third'"), "id", "ts_ms", "ts_ms", 5000))
    df = spark.createDataFrame(rows, "side string, id string, ts bigint")
    b = joins.reconcile(df.where("side = 'app'"), df.where("side = 'third'"), "id", "ts", "ts", 5000).where("pay_id <> 'z'")
    cols = ["pay_id", "app_ts", "third_ts", "status"]
    assert _set(st, cols) == _set(b, cols) and b.count() == 4


def test_window_count_on_map_state_equals_closed_batch(spark, folder):
    s = _stream(spark, folder).select("event_type", "ts_ms", "event_time")
    st, _ = _run(spark, P.apply_window_count_by_map(s, "event_type", "ts_ms", 2 * H))
    b = windows.count_per_window(_batch(spark), "ts_ms", 2 * H, keys=["event_type"], out="pv")
    closed = b.where(F.col("window_end") - 1 <= _max_ts(spark))
    cols = ["event_type", "window_start", "window_end", "pv"]
    got, exp = _set(st, cols), _set(closed, cols)
    assert set(got) <= set(_set(b, cols)) and len(got) >= 0.99 * len(exp) > 0
