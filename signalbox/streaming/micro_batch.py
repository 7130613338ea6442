"""Feed ingestion per micro-batch (T-01 ... T-04, T-06, T-07).

``process_feed_batch`` is the body of the ``foreachBatch`` sink: it splits a
batch of parsed messages into movements and cancellations, computes delays,
adds location names (broadcast dimension), and writes both fact tables. It is
also used by batch ingestion, so batch and stream write identical tables.
"""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from signalbox.constants import FEED_TRIGGER_INTERVAL, MAX_FILES_PER_TRIGGER
from signalbox.operators import transforms as tf
from signalbox.sinks.writers import _hadoop_fs, write_quarantine
from signalbox.sources.feed import quarantine_rows, read_feed_stream, read_feed_text_stream
from signalbox.streaming.admission import BatchCounts

log = logging.getLogger(__name__)


def process_feed_batch(
    batch: DataFrame,
    batch_id: int,
    location_dim: DataFrame,
    sink,
    dim_rows: int | None = None,
    after_write=None,
    counts: BatchCounts | None = None,
) -> None:
    """Split, type, enrich and write one batch of feed messages.

    The parsed batch is kept for the duration of the call because two writes
    read it. ``after_write(batch_id)`` (e.g. anomaly detection) runs after
    both writes; its failure is logged and does not fail the batch. A
    ``BatchStep`` makes up for it in its next call or in ``catch_up``.
    ``counts`` compares the messages with the rows that the writes took
    (the sink must write both frames) and fails the batch where they differ.
    """
    batch = batch.select("header", "body").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        movements = tf.add_location_names(
            tf.calculate_delay(tf.extract_movements(batch)), location_dim, dim_rows
        )
        cancellations = tf.add_location_names(tf.extract_cancellations(batch), location_dim, dim_rows)
        if counts is not None:
            (movements, cancellations), seen = counts.observed(movements, cancellations)
        sink.write(movements, cancellations, batch_id)
        if counts is not None:
            counts.check(batch, seen, batch_id)
    finally:
        batch.unpersist()
    if after_write is not None:
        try:
            after_write(batch_id)
        except Exception as exc:  # noqa: BLE001 - detection must not fail ingestion
            log.warning("post-write step failed in batch %s: %s", batch_id, exc)


def route_texts(texts: DataFrame, quarantine: str, batch_id: int) -> DataFrame:
    """S-11 in the stream: corrupt texts of a batch go to the quarantine table; the messages are returned."""
    good, bad = quarantine_rows(texts)
    write_quarantine(bad, quarantine, batch_id)
    return good


def first_batch(spark: SparkSession, checkpoint_dir: str, sink) -> int:
    """The number of this checkpoint's batch 0 in the sink.

    Spark counts the batches of a new checkpoint from 0, which would replace
    the sink's old batches and make later steps take new batches for finished
    ones. A new checkpoint therefore goes on after the sink's last batch. The
    number is kept as an empty marker in the checkpoint folder.
    """
    folder = f"{checkpoint_dir.rstrip('/')}/first_batch"
    fs, root = _hadoop_fs(spark, folder)
    marks = [int(s.getPath().getName()) for s in fs.listStatus(root)] if fs.exists(root) else []
    if marks:
        return max(marks)
    fresh = not fs.exists(_hadoop_fs(spark, f"{checkpoint_dir.rstrip('/')}/offsets")[1])
    number = sink.last_batch(spark) + 1 if fresh and hasattr(sink, "last_batch") else 0
    fs.create(_hadoop_fs(spark, f"{folder}/{number}")[1], True).close()
    return number


def start_feed_stream(
    spark: SparkSession,
    source_dir: str,
    checkpoint_dir: str,
    location_dim: DataFrame,
    sink,
    dim_rows: int | None = None,
    after_write=None,
    trigger: dict | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    quarantine: str | None = None,
    max_bytes_per_trigger: int | None = None,
    archive: str | None = None,
    counts: BatchCounts | None = None,
) -> StreamingQuery:
    """T-01 ... T-04: start the feed stream.

    ``trigger`` defaults to a 30-second processing-time trigger; pass
    ``{"availableNow": True}`` to drain the folder and stop. Progress is kept in
    ``checkpoint_dir`` (a shared folder on a cluster), so a restarted query
    resumes after the last committed batch; batches are written per
    ``batch_id`` partition, so a replayed batch replaces its own rows. A new
    checkpoint on old tables goes on numbering after their last batch.

    ``quarantine``: a folder for texts that are not messages. The files are
    then read as whole texts and routed two ways in each batch: messages to
    the tables as before, corrupt texts with their path to
    ``<quarantine>/batch_id=<n>`` (``read_quarantine``). Without it such files
    give no rows and leave no trace.

    ``max_bytes_per_trigger`` takes the place of the number of files;
    ``archive``: where files of committed batches move (``sources.feed.admitted``);
    ``counts``: checks messages in against rows out of each batch.
    """
    start = first_batch(spark, checkpoint_dir, sink)

    def process(batch: DataFrame, batch_id: int) -> None:
        if quarantine is not None:
            batch = route_texts(batch, quarantine, start + batch_id)
        process_feed_batch(batch, start + batch_id, location_dim, sink, dim_rows, after_write, counts)

    reader = read_feed_stream if quarantine is None else read_feed_text_stream
    stream = reader(spark, source_dir, max_files_per_trigger, max_bytes=max_bytes_per_trigger, archive=archive)
    writer = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or {"processingTime": FEED_TRIGGER_INTERVAL}))
    )
    return writer.start()


def run_until_stopped(query: StreamingQuery, timeout_seconds: float | None = None) -> None:
    """T-07: wait for the query; stop it on interrupt. Never stops the session."""
    try:
        query.awaitTermination(timeout_seconds)
    except KeyboardInterrupt:
        log.info("stopping stream %s", query.name)
    finally:
        try:
            if query.isActive:
                query.stop()
        except Exception as exc:  # noqa: BLE001 - gateway may already be gone
            log.info("stream stop raised %s", type(exc).__name__)
