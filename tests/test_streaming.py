import json
import os

from pyspark.sql import functions as F

from signalbox.operators import dedup, transforms as tf
from signalbox.operators.timeseries import station_window_stats
from signalbox.sinks.writers import ParquetFactSink, read_window_stats
from signalbox.sources import dimensions as dims
from signalbox.sources.tables import read_window_events, read_window_events_stream
from signalbox.streaming import micro_batch as mb
from signalbox.streaming.window_stream import start_window_stats_stream, window_events_from_csv
from tests.conftest import rows

T0 = 1_704_067_200_000


def _msg(i, kind="0003", delay_ms=60_000, train=None):
    body = {"train_id": train or f"T{i}", "loc_stanox": "00001" if i % 2 else "00002",
            "planned_timestamp": str(T0 + i * 1000), "actual_timestamp": str(T0 + i * 1000 + delay_ms),
            "variation_status": "LATE", "event_type": "ARRIVAL", "timetable_variation": "1",
            "canx_timestamp": str(T0 + i), "canx_reason_code": "R", "canx_type": "AT ORIGIN"}
    return {"header": {"msg_type": kind, "msg_queue_timestamp": "1", "source_system_id": "X"}, "body": body}


def _dim(spark):
    recs = [("00001", "T1", "AAA", "One", "1"), ("00002", "T2", "", "Two", "2")]
    return dims.location_dim(spark.createDataFrame(
        recs, "STANOX string, TIPLOC string, `3ALPHA` string, NLCDESC string, NLCDESC16 string"))


def _land(folder, name, obj):
    # landing contract: write under a temporary name, then rename into place
    tmp = os.path.join(folder, "." + name + ".tmp")
    with open(tmp, "w") as f:
        json.dump(obj, f, indent=2)
    os.replace(tmp, os.path.join(folder, name))


def test_stream_equals_batch_and_survives_replay(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    msgs = [_msg(i) for i in range(12)] + [_msg(i, "0002") for i in range(12, 16)]
    for n in range(4):
        _land(src, f"m{n}.json", msgs[n * 4:(n + 1) * 4])
    _land(src, "m4.json", msgs[0])           # a duplicate arriving in a later file
    with open(os.path.join(src, "m5_raw.txt"), "w") as f:
        f.write("garbage")                   # stray non-JSON file is ignored
    dim = _dim(spark)
    sink = ParquetFactSink(out)
    seen = []
    q = mb.start_feed_stream(spark, src, ckpt, dim, sink, after_write=seen.append,
                             trigger={"availableNow": True}, max_files_per_trigger=2)
    q.awaitTermination()
    assert len(seen) == 3 and seen == sorted(seen)  # 5 files, 2 per trigger

    streamed = dedup.dedup_movements(sink.read_movements(spark)).drop("inserted_at")
    feed = spark.read.option("multiLine", "true").schema(
        __import__("signalbox.schemas", fromlist=["FEED_SCHEMA"]).FEED_SCHEMA).json(os.path.join(src, "*.json"))
    batch = tf.movement_rows(tf.add_location_names(tf.calculate_delay(tf.extract_movements(feed)), dim))
    assert rows(streamed) == rows(batch.distinct())
    assert sink.read_movements(spark).count() == 13   # the cross-file duplicate is removed only on read
    assert sink.read_cancellations(spark).count() == 4

    # A restarted query with nothing new processes nothing.
    q = mb.start_feed_stream(spark, src, ckpt, dim, sink, trigger={"availableNow": True}, max_files_per_trigger=2)
    q.awaitTermination()
    assert sink.read_movements(spark).count() == 13

    # Replaying a batch (its commit was lost) rewrites its own partition only.
    replay = spark.read.option("multiLine", "true").schema(
        __import__("signalbox.schemas", fromlist=["FEED_SCHEMA"]).FEED_SCHEMA).json(
        [os.path.join(src, "m4.json")])
    mb.process_feed_batch(replay, 99, dim, sink)
    assert sink.read_movements(spark).count() == 14
    mb.process_feed_batch(replay, 99, dim, sink)
    assert sink.read_movements(spark).count() == 14
    assert dedup.dedup_movements(sink.read_movements(spark)).count() == 12


def test_detection_failure_does_not_fail_batch(spark, tmp_dir):
    def boom(batch_id):
        raise RuntimeError("detector down")

    sink = ParquetFactSink(tmp_dir)
    feed = spark.createDataFrame([(_msg(1)["header"], _msg(1)["body"])],
                                 __import__("signalbox.schemas", fromlist=["FEED_SCHEMA"]).FEED_SCHEMA)
    mb.process_feed_batch(feed, 0, _dim(spark), sink, after_write=boom)
    assert sink.read_movements(spark).count() == 1


def test_window_stream_equals_batch(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    lines = ["event_time,train_id,station,route,delay_minutes,is_cancelled"]
    rows_in = [("2024-01-01 00:01:00", "A", "S", 5, 0), ("2024-01-01 00:04:00", "B", "S", 7, 0),
               ("2024-01-01 00:12:00", "C", "S", 1, 1), ("2024-01-01 00:03:00", "D", "R", 2, 0)]
    for n, r in enumerate(rows_in):
        with open(os.path.join(src, f"e{n}.csv"), "w") as f:
            f.write("\n".join(lines + [",".join([r[0], r[1], r[2], "X", str(r[3]), str(r[4])])]) + "\n")
    stream = window_events_from_csv(spark, read_window_events_stream(spark, src, max_files_per_trigger=1))
    q = start_window_stats_stream(stream, out, ckpt, watermark="1 day", trigger={"availableNow": True})
    q.awaitTermination()
    streamed = read_window_stats(spark, out).select("window_start", "station", "event_count", "avg_delay",
                                                     "cancellation_count")
    batch_in = read_window_events(spark, src).select(
        "event_time", "station", F.col("delay_minutes").cast("double").alias("delay_minutes"), "is_cancelled")
    batch = station_window_stats(batch_in).select("window_start", "station", "event_count", "avg_delay",
                                                   "cancellation_count")
    assert rows(streamed) == rows(batch)
    assert len(rows(batch)) == 3


def test_latest_window_results_by_batch_number(spark, tmp_dir):
    from signalbox.sources.tables import read_latest_window_results

    header = "window_start,window_end,station,event_count,avg_delay,cancellation_count"
    for batch, station in ((9, "old"), (10, "new"), (2, "older")):
        folder = os.path.join(tmp_dir, f"batch_{batch}")
        os.makedirs(folder)
        with open(os.path.join(folder, "part.csv"), "w") as f:
            f.write(f"{header}\n2024-01-01 00:00:00,2024-01-01 00:10:00,{station},3,1.5,0\n")
    out = read_latest_window_results(spark, tmp_dir)
    assert [r.station for r in out.collect()] == ["new"]  # batch_10 is later than batch_9


def test_window_stream_drops_events_behind_the_watermark(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    header = "event_time,train_id,station,route,delay_minutes,is_cancelled"
    # Late rows are filtered with the watermark of the previous batch (Spark's
    # rule for late events), so the late row comes two batches after the
    # watermark passed its window.
    files = [["2024-01-01 00:05:00,A,S,X,5,0", "2024-01-01 01:00:00,B,S,X,1,0"],  # watermark -> 00:50
             ["2024-01-01 01:05:00,C,S,X,2,0"],
             ["2024-01-01 00:06:00,LATE,S,X,100,0"]]                             # window 00:00-00:10 is closed
    import time

    now = time.time()
    for n, lines in enumerate(files):
        path = os.path.join(src, f"e{n}.csv")
        with open(path, "w") as f:
            f.write("\n".join([header] + lines) + "\n")
        os.utime(path, (now - 100 + n * 10, now - 100 + n * 10))  # arrival order
    stream = window_events_from_csv(spark, read_window_events_stream(spark, src, max_files_per_trigger=1))
    q = start_window_stats_stream(stream, out, ckpt, watermark="10 minutes", trigger={"availableNow": True})
    q.awaitTermination()
    got = {str(r.window_start): (r.event_count, r.avg_delay)
           for r in read_window_stats(spark, out).collect()}
    assert got == {"2024-01-01 00:00:00": (1, 5.0), "2024-01-01 01:00:00": (2, 1.5)}


def test_incremental_detection_equals_full_recompute(spark, tmp_dir):
    from signalbox.plans.detection import detect_from_tables
    from signalbox.streaming.detection import IncrementalDetection, read_incremental_anomalies

    src, out, ckpt, ab = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt", "ab"))
    os.makedirs(src)
    mv = [_msg(i, delay_ms=60_000) for i in range(1, 28, 2)] + [_msg(51, delay_ms=7_200_000)]  # outlier + large

    mv += [_msg(60, delay_ms=1_900_000, train="L")]                                      # large delay only
    cx = [_msg(100 + i, "0002") for i in range(12)]  # 6 per station (odd/even), within one hour
    files = [mv[:6] + cx[:4], mv[6:12] + cx[4:8], mv[12:] + cx[8:] + [cx[0]]]  # last file replays a message
    import time

    now = time.time()
    for n, batch in enumerate(files):
        _land(src, f"f{n}.json", batch)
        os.utime(os.path.join(src, f"f{n}.json"), (now - 100 + n, now - 100 + n))
    from signalbox.streaming.clean import IncrementalClean

    dim = _dim(spark)
    sink = ParquetFactSink(out)
    clean = IncrementalClean(spark, sink, os.path.join(tmp_dir, "clean"))
    clean.then = IncrementalDetection(spark, sink, ab, station_bound=2, clean=clean)
    q = mb.start_feed_stream(spark, src, ckpt, dim, sink, after_write=clean,
                             trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()

    full = dedup.dedup_anomalies(detect_from_tables(spark, sink))
    incremental = dedup.dedup_anomalies(read_incremental_anomalies(spark, ab))
    kinds = sorted(r.anomaly_type for r in full.collect())
    assert kinds.count("cancellation_spike") == 2 and kinds.count("large_delay") == 2
    assert kinds.count("station_delay_outlier") == 1
    assert rows(incremental) == rows(full)


def test_feed_window_stream_counts_replays_once(spark, tmp_dir):
    from signalbox.streaming.window_stream import start_feed_window_stream

    src, out, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    msgs = [_msg(i * 60) for i in range(10)] + [_msg(i * 60 + 7, "0002") for i in range(4)]
    files = [msgs[:5], msgs[5:10] + [msgs[0]], msgs[10:] + [msgs[11]]]  # replays in later files
    import time

    now = time.time()
    for n, batch in enumerate(files):
        _land(src, f"w{n}.json", batch)
        os.utime(os.path.join(src, f"w{n}.json"), (now - 100 + n, now - 100 + n))
    dim = _dim(spark)
    q = start_feed_window_stream(spark, src, dim, out, ckpt, watermark="1 day",
                                 trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    streamed = read_window_stats(spark, out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "station", "event_count",
        "avg_delay", "cancellation_count")

    from signalbox.operators.timeseries import window_events

    feed = spark.read.option("multiLine", "true").schema(
        __import__("signalbox.schemas", fromlist=["FEED_SCHEMA"]).FEED_SCHEMA).json(os.path.join(src, "*.json"))
    mv = dedup.dedup_movements_on_write(tf.movement_rows(
        tf.add_location_names(tf.calculate_delay(tf.extract_movements(feed)), dim)))
    cx = dedup.dedup_cancellations_on_write(tf.cancellation_rows(
        tf.add_location_names(tf.extract_cancellations(feed), dim)))
    batch = station_window_stats(window_events(mv, cx)).select(
        "window_start", "station", "event_count", "avg_delay", "cancellation_count")
    assert rows(streamed) == rows(batch)
    assert sum(r.event_count for r in batch.collect()) == 14


def test_incremental_clean_tables_equal_full_dedup(spark, tmp_dir):
    from signalbox.streaming.clean import IncrementalClean, fold_batches, read_clean_table

    src, out, ckpt, clean = (os.path.join(tmp_dir, d) for d in ("src", "out", "ckpt", "clean"))
    os.makedirs(src)
    day = 86_400_000
    nulls = [_msg(i + 1) for i in range(2)]
    for m in nulls:
        m["body"]["train_id"] = None  # null key part
    mv = [_msg(i) for i in range(6)] + nulls
    late = _msg(3)
    late["body"]["planned_timestamp"] = str(T0 + 2 * day)
    late["body"]["actual_timestamp"] = str(T0 + 2 * day + 60_000)
    cx = [_msg(100 + i, "0002") for i in range(3)]
    files = [mv[:4] + cx[:2], mv[4:] + [mv[0], cx[0]] + cx[2:], [late, mv[6], mv[1]]]
    import time

    now = time.time()
    for n, batch in enumerate(files):
        _land(src, f"c{n}.json", batch)
        os.utime(os.path.join(src, f"c{n}.json"), (now - 100 + n, now - 100 + n))
    sink = ParquetFactSink(out)
    step = IncrementalClean(spark, sink, clean)
    q = mb.start_feed_stream(spark, src, ckpt, _dim(spark), sink, after_write=step,
                             trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    step(2)  # a finished batch is not folded again
    for kind in ("movements", "cancellations"):  # and folding it again appends nothing
        fold_batches(spark, sink, step.path(kind), 0, 2, kind)
    full_mv = dedup.dedup_movements(sink.read_movements(spark)).drop("inserted_at")
    full_cx = dedup.dedup_cancellations(sink.read_cancellations(spark)).drop("inserted_at")
    assert rows(read_clean_table(spark, step.path("movements"), "movements")) == rows(full_mv)
    assert rows(read_clean_table(spark, step.path("cancellations"), "cancellations")) == rows(full_cx)
    assert full_mv.count() == 9 and full_cx.count() == 3


def _run_files(spark, tmp_dir, files, after, sink):
    import time

    src, ckpt = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "ckpt")
    os.makedirs(src)
    now = time.time()
    for n, batch in enumerate(files):
        _land(src, f"f{n}.json", batch)
        os.utime(os.path.join(src, f"f{n}.json"), (now - 100 + n, now - 100 + n))
    mb.start_feed_stream(spark, src, ckpt, _dim(spark), sink, after_write=after,
                         trigger={"availableNow": True}, max_files_per_trigger=1).awaitTermination()


def test_failed_steps_are_caught_up_with_replays_and_null_times(spark, tmp_dir):
    """Each step fails once, one of them in the last batch; rows without a time are replayed."""
    from signalbox.plans.detection import detect_from_tables
    from signalbox.streaming.clean import IncrementalClean, read_clean_table
    from signalbox.streaming.detection import IncrementalDetection, read_incremental_anomalies

    mv = [_msg(i, delay_ms=60_000) for i in range(1, 28, 2)] + [_msg(51, delay_ms=7_200_000)]
    large = [_msg(60 + i, delay_ms=1_900_000, train=f"L{i}") for i in range(2)]
    cx = [_msg(100 + i, "0002") for i in range(12)]
    timeless = [_msg(200, train="N"), _msg(201, "0002", train="N")]
    timeless[0]["body"]["actual_timestamp"] = None
    timeless[1]["body"]["canx_timestamp"] = None
    files = [mv[:6] + cx[:4] + timeless, mv[6:12] + cx[4:8] + large[:1] + timeless,
             mv[12:] + cx[8:] + [cx[0], mv[0]] + large[1:] + timeless]

    class Once:
        """Raises the first time ``batch`` is the last one worked on."""

        def __init__(self, step, batch):
            self.work, self.batch, self.raised = step.process, batch, False
            step.process = self

        def __call__(self, first, last):
            if last == self.batch and not self.raised:
                self.raised = True
                raise OSError("transient")
            self.work(first, last)

    sink = ParquetFactSink(os.path.join(tmp_dir, "out"))
    ab = os.path.join(tmp_dir, "ab")
    clean = IncrementalClean(spark, sink, os.path.join(tmp_dir, "clean"))
    detect = IncrementalDetection(spark, sink, ab, station_bound=2, clean=clean)
    clean.then = detect
    faults = [Once(clean, 1), Once(detect, 2)]
    _run_files(spark, tmp_dir, files, clean, sink)
    assert all(f.raised for f in faults)
    assert clean.progress.done() == 2 and detect.progress.done() == 0
    clean.catch_up()
    assert detect.progress.done() == 2

    full_mv = dedup.dedup_movements(sink.read_movements(spark)).drop("inserted_at")
    full_cx = dedup.dedup_cancellations(sink.read_cancellations(spark)).drop("inserted_at")
    assert rows(read_clean_table(spark, clean.path("movements"), "movements")) == rows(full_mv)
    assert rows(read_clean_table(spark, clean.path("cancellations"), "cancellations")) == rows(full_cx)
    assert full_mv.filter("train_id = 'N'").count() == 1 and full_cx.filter("train_id = 'N'").count() == 1
    full = dedup.dedup_anomalies(detect_from_tables(spark, sink))
    found = dedup.dedup_anomalies(read_incremental_anomalies(spark, ab))
    kinds = [r.anomaly_type for r in full.collect()]
    assert {k: kinds.count(k) for k in kinds} == {
        "cancellation_spike": 2, "large_delay": 3, "station_delay_outlier": 1}
    # z scores come from sums of doubles, whose last digits follow the summation order
    score = F.round("anomaly_score", 9)
    assert rows(found.withColumn("anomaly_score", score)) == rows(full.withColumn("anomaly_score", score))


def test_steps_refuse_a_sink_that_cannot_read_batches(spark, tmp_dir):
    import pytest

    from signalbox.sinks.writers import JdbcFactSink
    from signalbox.streaming.clean import IncrementalClean
    from signalbox.streaming.detection import IncrementalDetection

    sink = JdbcFactSink("jdbc:none")
    with pytest.raises(TypeError, match="single batches"):
        IncrementalClean(spark, sink, tmp_dir)
    with pytest.raises(TypeError, match="single batches"):
        IncrementalDetection(spark, sink, tmp_dir)
