"""Replay in sorted runs and bounded top-N state."""

import os
import tracemalloc
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventide.operators import stateful, topn
from eventide.session import shared_path
from eventide.streaming import processors as P
from eventide.streaming import streams as S
from eventide.streaming.replay import sorted_blocks
from eventide.streaming.run import run_available

H = 3_600_000


class Store:
    """A map state whose values lie in files."""

    def __init__(self, folder):
        self.folder, self.most = folder, 0

    def _path(self, key):
        return os.path.join(self.folder, "-".join(map(str, key)))

    def updateValue(self, key, value):
        with open(self._path(key), "wb") as f:
            f.write(value[0])

    def getValue(self, key):
        with open(self._path(key), "rb") as f:
            return (f.read(),)

    def removeKey(self, key):
        os.remove(self._path(key))


def _frames(n, step, seed, wide=False):
    rng = np.random.default_rng(seed)
    for at in range(0, n, step):
        k = min(step, n - at)
        pdf = pd.DataFrame({"t": rng.integers(0, max(n // 3, 1), k), "id": np.arange(at, at + k)})
        yield pdf.assign(text=[f"{i}" + "x" * 50_000 for i in range(k)]) if wide else pdf


@pytest.mark.parametrize("n, run_rows", [(0, 100), (1, 100), (100, 100), (101, 100), (5_000, 100), (6_000, 50), (1_000, 1)])
def test_blocks_follow_the_order(tmp_path, n, run_rows):
    """One run, a full run, many runs merged at several levels, runs of one frame."""
    want = pd.concat([*_frames(n, 37, 1), pd.DataFrame({"t": [], "id": []}, dtype="int64")]).sort_values(["t", "id"])
    got = list(sorted_blocks(_frames(n, 37, 1), ["t", "id"], Store(tmp_path), run_rows))
    rows = pd.concat(got) if got else want.iloc[:0]
    assert rows["t"].tolist() == want["t"].tolist() and rows["id"].tolist() == want["id"].tolist()
    assert os.listdir(tmp_path) == []       # nothing stays in state


def test_nulls_and_ties_across_runs(tmp_path):
    frames = [pd.DataFrame({"t": [3.0, None, 1.0, 1.0], "id": [i] * 4}) for i in range(200)]
    got = pd.concat(sorted_blocks(iter(frames), ["t"], Store(tmp_path), 16))
    assert got["t"].fillna(9).is_monotonic_increasing and len(got) == 800
    assert got.groupby("id").size().eq(4).all()


@pytest.mark.parametrize("n, step, wide, run_rows", [(600_000, 5_000, False, 10_000), (4_000, 20, True, 100_000)])
def test_memory_does_not_grow_with_the_rows(tmp_path, n, step, wide, run_rows):
    """A quarter of the rows and all of them: about the same peak (long texts: runs end by bytes)."""
    peaks = []
    for rows in (n // 4, n):
        tracemalloc.start()
        seen = 0
        for block in sorted_blocks(_frames(rows, step, 2, wide), ["t"], Store(tmp_path), run_rows):
            seen += len(block)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert seen == rows
    assert peaks[1] < 1.3 * peaks[0]


# --- streams with one key that holds a whole micro-batch ----------------------------------

ROWS = 20_000


@pytest.fixture(scope="module")
def one_key(spark):
    """20,000 events of one key, unordered, in one file."""
    path = shared_path(spark, "one-key")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    i = F.col("id")
    t = F.pmod(F.xxhash64(i), F.lit(50 * H))
    (spark.range(ROWS).select(i.alias("event_id"), F.lit(7).cast("bigint").alias("user_id"), t.alias("ts_ms"),
                              F.element_at(F.array(*map(F.lit, ["view", "click", "purchase"])), (i % 3 + 1).cast("int")).alias("event_type"),
                              (i % 11).cast("double").alias("value"))
     .coalesce(1).write.parquet(path))
    spark.conf.set("eventide.replay.rows", "1500")
    yield path, spark.read.parquet(path)
    spark.conf.unset("eventide.replay.rows")


def _stream(spark, one_key):
    path, batch = one_key
    return S.watermarked(spark.readStream.schema(batch.schema).parquet(path))


def _run(spark, df):
    return run_available(df, "r_" + uuid.uuid4().hex[:8], shared_path(spark, "ckpt"))


def _set(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _last(batch):
    return batch.agg(F.max("ts_ms")).first()[0]


def test_rolling_in_runs(spark, one_key):
    st, q = _run(spark, P.apply_rolling(_stream(spark, one_key), "user_id", "sum", "value", ["ts_ms", "event_id"], "event_id", "total"))
    rows = sorted(one_key[1].collect(), key=lambda r: (r.ts_ms, r.event_id))
    want = list(zip([r.event_id for r in rows], np.cumsum([r.value for r in rows])))
    assert _set(st, ["event_id", "total"]) == sorted(want, key=repr) and len(want) == ROWS
    op = q.lastProgress["stateOperators"][0]
    assert op["numRowsTotal"] <= 2          # the sum alone; no run is left


def test_periodic_count_in_runs(spark, one_key):
    st, _ = _run(spark, P.apply_periodic_count(_stream(spark, one_key), "user_id", "ts_ms", 10_000))
    b = stateful.periodic_counts(one_key[1], "user_id", "ts_ms", 10_000)
    cols = ["user_id", "fire_ts", "pv"]
    assert _set(st, cols) == _set(b.where(F.col("fire_ts") < _last(one_key[1])), cols)


def test_followed_by_in_runs(spark, one_key):
    args = ("user_id", "ts_ms", "event_id", F.col("event_type") == "view", F.col("event_type") == "purchase", 20_000)
    st, _ = _run(spark, P.apply_followed_by(_stream(spark, one_key), *args))
    got = _set(st, ["begin_event_id", "end_event_id", "status"])
    rows, open_, want = sorted(one_key[1].collect(), key=lambda r: (r.ts_ms, r.event_id)), [], []
    for r in rows:
        if r.event_type == "purchase":
            want += [(b.event_id, r.event_id, "matched") if r.ts_ms - b.ts_ms < 20_000 else (b.event_id, None, "timeout") for b in open_]
            open_ = []
        elif r.event_type == "view":
            open_.append(r)
    want += [(b.event_id, None, "timeout") for b in open_ if b.ts_ms + 20_000 < _last(one_key[1])]
    assert got == sorted(want, key=repr) and {w[2] for w in want} == {"matched", "timeout"}


def test_buffer_in_runs(spark, one_key):
    st, _ = _run(spark, P.apply_buffer(_stream(spark, one_key).drop("event_time"), 7, ["event_id", "ts_ms"], ["ts_ms", "event_id"], shards=1))
    order = [r.event_id for r in sorted(one_key[1].collect(), key=lambda r: (r.ts_ms, r.event_id))]
    want = [(i // 7, i % 7 + 1, e) for i, e in enumerate(order[:ROWS // 7 * 7])]
    assert _set(st, ["batch_no", "pos", "event_id"]) == sorted(want, key=repr)


# --- top-N with a bounded state ------------------------------------------------------------

@pytest.mark.parametrize("text", [False, True])
def test_top_n_of_100_000_items(spark, text):
    """One window of 100,000 items (a null one among them), then a row that closes it."""
    item = (F.col("id") % 100_000 + (1 << 60)).cast("bigint")
    item = F.when(F.col("id") % 100_000 != 17, item.cast("string") if text else item)
    copies = F.when(F.col("id") % 100_000 == 17, 9).when(F.col("id") % 20_000 == 3, 9).otherwise(1)
    rows = spark.range(100_000).select(item.alias("item"), F.explode(F.sequence(F.lit(1), copies)).alias("k"),
                                       (F.col("id") % H).alias("ts_ms"))
    path = shared_path(spark, "many-items")
    rows.select("item", "ts_ms").coalesce(1).write.parquet(path)
    spark.range(1).select(F.lit(None).cast(rows.schema["item"].dataType).alias("item"), F.lit(3 * H).cast("bigint").alias("ts_ms")
                          ).coalesce(1).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    stream = S.watermarked(spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(path))
    st, q = _run(spark, S.top_n_stream(stream, "event_time", "item", H, H, 4))
    b = topn.top_n_per_window(table, "ts_ms", "item", H, H, 4).where(F.col("window_end") <= 3 * H)
    cols = ["window_start", "window_end", "item", "cnt", "rank"]
    assert _set(st, cols) == _set(b, cols) and st.count() == 4
    assert st.where("item is null").first()["rank"] == 1
    held = [sorted(o["numRowsUpdated"] for o in p["stateOperators"]) for p in q.recentProgress if len(p["stateOperators"]) == 2]
    assert max(h[1] for h in held) >= 100_000 and max(h[0] for h in held) <= 10
