"""Sinks and sources: file roll by row count, JSON lines, print / memory,
the rate demo stream, processing-time timers, reading the watermark."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from data_dirs import SF_SMALL
from eventide.operators import sinks
from eventide.session import shared_path
from eventide.sources.streams import event_stream, text_lines
from eventide.sources.tables import events
from eventide.streaming import processors as P
from eventide.streaming import streams as S
from eventide.streaming.run import final_watermark_ms, run_available, run_foreach_batch
from streamutil import split_by_time


def test_text_sink_rolls_by_row_count(spark, scratch):
    df = events(spark, SF_SMALL).select(F.col("event_id").cast("string").alias("value")).coalesce(1)
    out = os.path.join(scratch, "rolled")
    sinks.write_text(df, out, max_records_per_file=100)
    files = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == 10
    assert spark.read.text(out).count() == 1000


def test_json_lines_writer_is_idempotent(spark, scratch):
    docs = sinks.document_payload(events(spark, SF_SMALL), "user_id", "event_type")
    write = sinks.json_lines_writer(os.path.join(scratch, "docs"))
    write(docs, 0)
    write(docs, 0)  # replay of the same batch id
    back = spark.read.text(os.path.join(scratch, "docs"))
    assert back.count() == 1000
    assert back.first().value.startswith('{"')


def test_upsert_keeps_latest_per_key_across_batches(spark, scratch):
    path = os.path.join(scratch, "kv")
    write = sinks.upsert_writer(sinks.parquet_store(path), "k", ["v"], ["ts", "id"])
    schema = "k string, ts bigint, id bigint, v string"
    write(spark.createDataFrame([("a", 1, 1, "x"), ("a", 3, 2, "tie"), ("a", 3, 4, "y"), ("b", 2, 3, "z"), (None, 1, 9, "n")], schema), 0)
    second = spark.createDataFrame([("a", 2, 5, "late"), ("b", 5, 6, "new"), ("c", 1, 7, "c")], schema)
    write(second, 1)
    write(second, 1)  # a replay
    got = {r.k: (r.v, r.id) for r in sinks.latest(spark, path, "k", ["v"], ["ts", "id"]).collect()}
    assert got == {"a": ("y", 4), "b": ("new", 6), "c": ("c", 7), None: ("n", 9)}


def test_checkpoint_folder_is_required_outside_local_mode():
    from eventide.session import ensure_checkpoint_dir

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_memory_print_sink(spark, scratch):
    folder = os.path.join(scratch, "printed")
    schema = split_by_time(spark, os.path.join(SF_SMALL, "events.parquet"), folder, 2)
    s = event_stream(spark, folder, schema).select("event_id")
    name = "print_" + uuid.uuid4().hex[:6]
    q = sinks.print_sink(s, name, shared_path(spark, "ck")).format("memory").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table(name).count() == 1000


def test_processing_time_timers(spark, scratch):
    folder = os.path.join(scratch, "ev")
    schema = split_by_time(spark, os.path.join(SF_SMALL, "events.parquet"), folder, 2)
    s = event_stream(spark, folder, schema, max_files_per_trigger=1)
    out = os.path.join(scratch, "out")

    def writer(batch, batch_id):
        batch.write.mode("overwrite").parquet(os.path.join(out, f"b={batch_id}"))

    def written():
        parts = [os.path.join(out, d) for d in os.listdir(out)] if os.path.exists(out) else []
        parts = [d for d in parts if os.path.exists(os.path.join(d, "_SUCCESS"))
                 and any(f.endswith(".parquet") for f in os.listdir(d))]
        return spark.read.parquet(*parts) if parts else None

    q = (P.apply_arrival_timer(s.select("event_id"), "event_id", F.pmod("event_id", F.lit(3)), 200).writeStream.foreachBatch(writer)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 90
        while time.time() < deadline:
            time.sleep(1)
            got = written()
            if got is not None and got.where("kind = 'timer'").count() >= 2 \
                    and got.where("kind = 'arrival'").count() == 1000:
                break
    finally:
        q.stop()
    got = written()
    assert got.where("kind = 'arrival'").count() == 1000
    assert got.where("kind = 'timer'").count() >= 2


def test_flat_map_reads_watermark(spark, scratch):
    folder = os.path.join(scratch, "ev")
    schema = split_by_time(spark, os.path.join(SF_SMALL, "events.parquet"), folder, 3)
    s = S.watermarked(event_stream(spark, folder, schema, max_files_per_trigger=1)
                      .select("event_id", "user_id", "event_type", "ts_ms", "event_time"), "ts_ms", 0)
    times = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2).otherwise(0)
    st, q = run_available(P.apply_repeat_with_watermark(s, "user_id", ["event_id", "ts_ms"], times),
                          "wm_" + uuid.uuid4().hex[:6], os.path.join(scratch, "ck"))
    b = events(spark, SF_SMALL)
    expected = b.where("event_type = 'view'").count() + 2 * b.where("event_type = 'click'").count()
    assert st.count() == expected
    wms = sorted({r.watermark_ms for r in st.collect()})
    assert len(wms) >= 2          # the watermark advances between micro-batches
    assert wms[0] <= 0 < wms[-1]
    assert final_watermark_ms(q) == b.agg(F.max("ts_ms")).first()[0]


def test_text_lines_bounded_and_streaming(spark, scratch):
    path = os.path.join(scratch, "lines")
    sinks.write_text(spark.createDataFrame([("one",), ("two",)], "value string"), path)
    assert sorted(r.value for r in text_lines(spark, path).collect()) == ["one", "two"]
    assert text_lines(spark, path, streaming=True).isStreaming


def test_flat_map_with_any_code(spark):
    from eventide.operators.relational import flat_map

    def fn(row):
        for i in range(row["n"]):
            yield row["k"].upper(), i

    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "k string, n int")
    assert sorted(tuple(r) for r in flat_map(df, fn, "k string, i int").collect()) == [("A", 0), ("A", 1), ("C", 0)]


def test_parallelism_and_processing_time_clock(spark):
    from eventide.functions.time import processing_time
    from eventide.operators.partitioning import with_parallelism
    df = spark.range(100)
    assert with_parallelism(df, 3).rdd.getNumPartitions() == 3
    assert with_parallelism(df, 5, ["id"]).rdd.getNumPartitions() == 5
    now = df.limit(1).select(F.unix_millis(processing_time()).alias("ms")).first().ms
    assert abs(now - time.time() * 1000) < 600_000
