"""Late rows, corrupt files and restarted numbering in running streams."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from signalbox.operators import dedup, transforms as tf
from signalbox.operators.timeseries import station_window_stats, window_events
from signalbox.sinks.writers import ParquetFactSink, read_quarantine, read_window_stats
from signalbox.sources.feed import read_feed
from signalbox.sources.tables import read_window_events, read_window_events_stream
from signalbox.streaming import micro_batch as mb
from signalbox.streaming.clean import IncrementalClean
from signalbox.streaming.late_windows import EventFacts, FeedEvents, LateWindows, start_event_landing
from signalbox.streaming.window_stream import (
    start_feed_window_stream,
    start_window_stats_stream,
    window_events_from_csv,
)
from tests.conftest import rows
from tests.test_streaming import T0, _dim, _msg

COLUMNS = ["window_start", "window_end", "station", "event_count", "avg_delay", "cancellation_count"]
DRAIN = {"availableNow": True}


def _files(folder, texts):
    """Files in order of arrival; ``texts``: name -> content."""
    os.makedirs(folder, exist_ok=True)
    now = time.time() - 1000
    for n, (name, text) in enumerate(texts.items()):
        path = os.path.join(folder, name)
        with open(path, "w") as f:
            f.write(text)
        os.utime(path, (now + n, now + n))


def _stats(df):
    return rows(df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.startswith("window") else F.col(c) for c in COLUMNS]))


@pytest.mark.parametrize("seed, files_per_batch", [(1, (1, 1)), (2, (3, 1)), (3, (1, 4))])
def test_csv_stream_equals_batch_under_any_delay(spark, tmp_dir, seed, files_per_batch):
    """Events up to a day late in random order, the two queries with different batches."""
    rng = random.Random(seed)
    src, out, facts = (os.path.join(tmp_dir, d) for d in ("src", "out", "facts"))
    header = "event_time,train_id,station,route,delay_minutes,is_cancelled\n"
    lines = [f"2024-01-0{rng.randint(1, 2)} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00,T{i},"
             f"{rng.choice(['S', 'R', ''])},X,{rng.choice(['', i % 50])},{i % 3 // 2}" for i in range(90)]
    _files(src, {f"e{n:02d}.csv": header + "\n".join(lines[n * 9:n * 9 + 9]) + "\n" for n in range(10)})
    for name, step in (("stream", False), ("landing", True)):
        stream = window_events_from_csv(
            spark, read_window_events_stream(spark, src, max_files_per_trigger=files_per_batch[step]))
        ckpt = os.path.join(tmp_dir, "ckpt-" + name)
        if step:
            source = EventFacts(spark, facts)
            late = LateWindows(spark, source, out, "10 minutes")
            query = start_event_landing(stream, source, ckpt, late, DRAIN)
        else:
            query = start_window_stats_stream(stream, out, ckpt, watermark="10 minutes", trigger=DRAIN)
        query.awaitTermination()
        if not step:
            dropped = 90 - read_window_stats(spark, out).agg(F.sum("event_count")).first()[0]
            assert dropped > 20  # the stream alone lost rows
    batch = station_window_stats(window_events_from_csv(spark, read_window_events(spark, src)))
    assert _stats(read_window_stats(spark, out)) == _stats(batch)
    # Batches that are worked on again change nothing.
    late.process(0, late.progress.done())
    assert _stats(read_window_stats(spark, out)) == _stats(batch)


def test_feed_windows_equal_batch_with_late_messages_and_replays(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    hour = 3600
    early = [_msg(i * 60) for i in range(8)] + [_msg(i * 60 + 7, "0002") for i in range(4)]
    later = [_msg(i * 60 + 5 * hour) for i in range(8)]
    behind = [_msg(i * 60 + 30) for i in range(5)] + [_msg(99, "0002"), _msg(-90 * hour)]
    files = [early, later, later[:2], behind + early[:3], [_msg(6 * hour)], [_msg(31), behind[0]]]
    _files(src, {f"f{n}.json": json.dumps(b) for n, b in enumerate(files)})
    dim = _dim(spark)
    start_feed_window_stream(spark, src, dim, out, os.path.join(tmp_dir, "w"), watermark="1 hour", trigger=DRAIN,
                             max_files_per_trigger=1).awaitTermination()
    assert read_window_stats(spark, out).agg(F.sum("event_count")).first()[0] < 29
    sink = ParquetFactSink(os.path.join(tmp_dir, "facts"))
    clean = IncrementalClean(spark, sink, os.path.join(tmp_dir, "clean"))
    clean.then = LateWindows(spark, FeedEvents(clean), out, "1 hour")
    mb.start_feed_stream(spark, src, os.path.join(tmp_dir, "i"), dim, sink, after_write=clean, trigger=DRAIN,
                         max_files_per_trigger=2).awaitTermination()
    assert clean.then.progress.done() == 2
    feed = read_feed(spark, src)
    mv = dedup.dedup_movements_on_write(tf.movement_rows(
        tf.add_location_names(tf.calculate_delay(tf.extract_movements(feed)), dim)))
    cx = dedup.dedup_cancellations_on_write(tf.cancellation_rows(
        tf.add_location_names(tf.extract_cancellations(feed), dim)))
    batch = station_window_stats(window_events(mv, cx))
    assert _stats(read_window_stats(spark, out)) == _stats(batch)
    assert batch.agg(F.sum("event_count")).first()[0] == 29


def test_corrupt_files_are_kept_with_their_path(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    texts = {
        "a.json": json.dumps([_msg(1), _msg(2)], indent=2), "cut.json": json.dumps(_msg(3), indent=2)[:90],
        "b.json": json.dumps(_msg(4), indent=2), "blank.json": " \n", "empty.json": "", "text.json": "Service unavailable\nTry later",
        "number.json": "17", "c.json": json.dumps([_msg(5, "0002"), _msg(6)]), "half.json": '[{"header": {}}, 5',
        "left_raw.txt": "not read",
    }
    _files(src, texts)
    dim = _dim(spark)
    tables = {}
    for name, quarantine in (("plain", None), ("routed", os.path.join(tmp_dir, "bad"))):
        sink = ParquetFactSink(os.path.join(tmp_dir, name))
        mb.start_feed_stream(spark, src, os.path.join(tmp_dir, "ckpt-" + name), dim, sink, trigger=DRAIN,
                             max_files_per_trigger=3, quarantine=quarantine).awaitTermination()
        tables[name] = [rows(t.drop("inserted_at")) for t in (sink.read_movements(spark), sink.read_cancellations(spark))]
    assert tables["routed"] == tables["plain"] and len(tables["plain"][0]) == 4
    kept = {os.path.basename(r.file_path): r.raw_text for r in read_quarantine(spark, quarantine).collect()}
    assert kept == {n: texts[n] for n in ("cut.json", "blank.json", "text.json", "number.json", "half.json")}
    # A batch that is delivered again replaces its own texts.
    batch = spark.read.text(os.path.join(src, "cut.json"), wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("file_path"))
    number = read_quarantine(spark, quarantine).filter("file_path LIKE '%cut.json'").first().batch_id
    before = read_quarantine(spark, quarantine).filter(F.col("batch_id") != number).count()
    for _ in range(2):
        assert mb.route_texts(batch, quarantine, number).count() == 0
        assert read_quarantine(spark, quarantine).count() == before + 1
    assert read_quarantine(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_a_new_checkpoint_goes_on_numbering(spark, tmp_dir):
    """Its batches neither replace old ones nor pass for finished ones."""
    src, dim = os.path.join(tmp_dir, "src"), _dim(spark)
    sink = ParquetFactSink(os.path.join(tmp_dir, "facts"))
    clean = IncrementalClean(spark, sink, os.path.join(tmp_dir, "clean"))
    for run in range(2):
        _files(src, {f"r{run}-{n}.json": json.dumps([_msg(10 * run + n)]) for n in range(3)})
        for _ in range(2):  # a restart on the same checkpoint keeps its numbers
            mb.start_feed_stream(spark, src, os.path.join(tmp_dir, f"ckpt{run}"), dim, sink, after_write=clean,
                                 trigger=DRAIN, max_files_per_trigger=1).awaitTermination()
    assert sink.last_batch(spark) == clean.progress.done() == 8  # three batches, then all six files again
    assert clean.history("movements").count() == 6 and dedup.dedup_movements(sink.read_movements(spark)).count() == 6
    with pytest.raises(ValueError, match="go on where"):
        clean(3)
    assert T0
