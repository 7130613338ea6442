"""Folded days of the fact tables, and batches bounded by bytes with counts."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from signalbox.operators import transforms as tf
from signalbox.sinks.layout import FoldedTable
from signalbox.sinks.writers import MOVEMENT_TIME, ParquetFactSink
from signalbox.schemas import MOVEMENT_TABLE_SCHEMA
from signalbox.streaming import micro_batch as mb
from signalbox.streaming.admission import BatchCounts, waiting
from tests.conftest import rows
from tests.helpers import feed_df, message, movement
from tests.test_late_rows import DRAIN, _files
from tests.test_streaming import T0, _dim, _msg

DAY = 86_400
FIRST = datetime.date(2024, 1, 1)


def _write(spark, sink, batch_id, seconds):
    """A batch with one movement for each number of seconds after the first day began (None: no time)."""
    feed = feed_df(spark, [movement(f"T{batch_id}-{s}", actual=None if s is None else T0 + s * 1000) for s in seconds])
    moves = tf.add_location_names(tf.calculate_delay(tf.extract_movements(feed)), _dim(spark))
    cancels = tf.add_location_names(tf.extract_cancellations(feed), _dim(spark))
    sink.write(moves, cancels, batch_id)


def _folders(path):
    found = [os.path.join(path, d) for d in os.listdir(path) if d.startswith("event_date=")]
    return sorted(f"{os.path.basename(d)}/{b}" for d in found for b in os.listdir(d) if b.startswith("batch_id="))


def test_reads_are_equal_before_during_and_after_a_fold(spark, tmp_dir):
    sink = ParquetFactSink(tmp_dir)
    for n in range(6):
        _write(spark, sink, n, [n, DAY + n, None if n % 2 else 5])
    table = FoldedTable(spark, sink.movements_path, MOVEMENT_TABLE_SCHEMA)
    early = sink.read_movements_with_batch(spark)  # a reader that has listed the batch folders
    before = rows(early)
    assert len(_folders(sink.movements_path)) == 15
    assert table.fold(FIRST + datetime.timedelta(1), 4, MOVEMENT_TIME) == [None, FIRST]
    assert rows(sink.read_movements_with_batch(spark)) == before == rows(early)
    assert table.retire(3600) == []  # within the grace of running readers
    assert len(table.retire(0)) == 7
    assert rows(sink.read_movements_with_batch(spark)) == before
    # Left: the second day's batches, and those after the fold.
    assert len(_folders(sink.movements_path)) == 8
    assert rows(sink.read_movements_with_batch(spark, since=5)) == [r for r in before if r[-1] == 5]
    assert rows(sink.read_movements_with_batch(spark, since=3)) == [r for r in before if r[-1] >= 3]
    # A late batch of a folded day is read, and the next fold takes it up.
    _write(spark, sink, 6, [77, 3 * DAY])
    before = rows(sink.read_movements_with_batch(spark))
    assert len(before) == 20
    assert table.fold(FIRST + datetime.timedelta(2), 6, MOVEMENT_TIME) == [None, FIRST, FIRST + datetime.timedelta(1)]
    table.retire(0)
    assert rows(sink.read_movements_with_batch(spark)) == before
    assert _folders(sink.movements_path) == ["event_date=2024-01-04/batch_id=6"]
    assert os.listdir(os.path.join(table.folded, "fold=0")).count("event_date=2024-01-01") == 0
    assert sink.last_batch(spark) == 6
    # Folding what is folded writes nothing; bounds do not go back.
    assert table.fold(FIRST + datetime.timedelta(2), 6, MOVEMENT_TIME) == []
    with pytest.raises(ValueError, match="earlier fold"):
        table.fold(FIRST, 6, MOVEMENT_TIME)


def test_folded_files_are_sorted_and_a_failed_fold_is_not_read(spark, tmp_dir):
    sink = ParquetFactSink(tmp_dir)
    for n in range(3):
        _write(spark, sink, n, [100 - n * 7 - k for k in range(5)])
    before = rows(sink.read_movements_with_batch(spark))
    table = FoldedTable(spark, sink.movements_path, MOVEMENT_TABLE_SCHEMA)
    wrote = table.log.write
    table.log.write = lambda *a: 1 / 0  # fails after the files, before the log
    with pytest.raises(ZeroDivisionError):
        table.fold(FIRST + datetime.timedelta(1), 2, MOVEMENT_TIME)
    assert rows(sink.read_movements_with_batch(spark)) == before
    table.log.write = wrote
    sink.fold_days(spark, FIRST + datetime.timedelta(1), through=2, grace_seconds=0)
    assert rows(sink.read_movements_with_batch(spark)) == before and _folders(sink.movements_path) == []
    files = spark.read.parquet(os.path.join(table.folded, "fold=0", "event_date=2024-01-01")).withColumn(
        "file", F.input_file_name()).select("file", MOVEMENT_TIME).collect()
    by_file = {}
    for f, at in files:
        by_file.setdefault(f, []).append(at)
    assert all(v == sorted(v) for v in by_file.values())
    spans = sorted((v[0], v[-1]) for v in by_file.values())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_backlog_by_bytes_with_counts_and_archive(spark, tmp_dir):
    src, archive = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "archive")
    msgs = [[_msg(4 * n + k, ("0003", "0002", "0003", "0005")[k]) for k in range(4)] for n in range(6)]
    _files(src, {f"m{n}.json": json.dumps(m + m[:1]) for n, m in enumerate(msgs)})  # with a repeat in each file
    size = os.path.getsize(os.path.join(src, "m5.json"))
    sink, counts = ParquetFactSink(os.path.join(tmp_dir, "facts")), BatchCounts(spark, os.path.join(tmp_dir, "counts"), src)
    total = waiting(spark, src)
    assert total[0] == 6
    query = mb.start_feed_stream(spark, src, os.path.join(tmp_dir, "ckpt"), _dim(spark), sink, trigger=DRAIN,
                                 max_bytes_per_trigger=2 * size + 10, archive=archive, counts=counts)
    query.awaitTermination()
    kept = counts.read()
    assert kept.select("batch_id").distinct().count() == 3  # two files a batch
    assert rows(kept.groupBy("kind").agg(F.sum("messages"), F.sum("written"))) == [
        ("0002", 6, 6), ("0003", 18, 18), ("other", 6, None)]
    assert kept.filter("batch_id = 0").first().waiting_bytes == total[1]
    assert sink.read_movements(spark).count() == 12  # repeats within a batch are counted, not stored
    moved = [f for _, _, files in os.walk(archive) for f in files if f.endswith(".json")]
    left = [f for f in os.listdir(src) if f.endswith(".json")]
    assert sorted(moved + left) == [f"m{n}.json" for n in range(6)] and "m0.json" in moved


def test_rows_that_multiply_stop_the_batch(spark, tmp_dir):
    dim = _dim(spark)
    counts = BatchCounts(spark, os.path.join(tmp_dir, "counts"))
    feed = feed_df(spark, [movement("A", "00001", actual=T0), movement("B", "00002", actual=T0), message("0009")])
    with pytest.raises(RuntimeError, match="0003: 2 in, 4 out"):
        mb.process_feed_batch(feed, 0, dim.unionByName(dim), ParquetFactSink(os.path.join(tmp_dir, "t")), counts=counts)
    mb.process_feed_batch(feed, 0, dim, ParquetFactSink(os.path.join(tmp_dir, "t")), counts=counts)
    assert rows(counts.read(), "kind", "messages", "written") == [("0002", 0, 0), ("0003", 2, 2), ("other", 1, None)]
