"""Incremental anomaly detection after each ingested micro-batch.

Re-running detection over the whole history after every micro-batch (what a
plain ``after_write=run_detection`` does) costs a full scan per trigger. This
step does only the work a batch can change:

* large delays (X-01) are row-local: detect on the new batches' rows;
* cancellation spikes (X-03): recount only the (station, bucket) pairs the
  new batches touched, over the deduplicated history of those buckets (a range
  filter on the time column that Parquet statistics can prune, plus a
  broadcast semi-join with the touched pairs, bounded by the batch size);
* station outliers (X-02) depend on whole-station statistics. Beside clean
  tables they come from a state that is carried from batch to batch
  (``streaming/outliers``): a call reads the rows its batches added, the
  state, and the state's tail of high delays. Without clean tables every call
  recomputes them over the deduplicated history. Either way they are published
  as a complete snapshot under ``<path>/_outliers``.

Large delays and spikes are written to ``<path>/batch_id=<n>`` with a ``kind``
column. A call works on every batch since the last finished one, so a failed
call is made up for by the next. ``read_incremental_anomalies`` combines the
parts: large-delay rows once per anomaly key (D-05), the latest count per
spike bucket (kept only while it still reaches the threshold), and the newest
outlier snapshot; after D-05 the result equals a full recompute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox import constants as C
from signalbox.functions.columns import epoch_ms_to_ts, ts_to_epoch_ms
from signalbox.operators import dedup
from signalbox.operators.anomaly import (
    detect_cancellation_spikes,
    detect_large_delays,
    detect_station_delay_outliers,
)
from signalbox.operators.joins import join_small
from signalbox.schemas import ANOMALY_COLUMNS, ANOMALY_SCHEMA
from signalbox.sinks.writers import (
    BATCH_COLUMN,
    DATE_COLUMN,
    prune_snapshots,
    read_snapshot,
    replace_snapshot,
    stored_schema,
    write_batch_partition,
)
from signalbox.streaming.clean import IncrementalClean
from signalbox.streaming.outliers import OutlierState
from signalbox.streaming.progress import BatchStep, in_batches

KIND_LARGE, KIND_SPIKE = "large_delay", "cancellation_spike"
SNAPSHOT_AGE_SECONDS = 3600  # superseded outlier snapshots stay readable this long


def _outlier_path(path: str) -> str:
    return f"{path.rstrip('/')}/_outliers"


class IncrementalDetection(BatchStep):
    """``after_write`` callback for ``start_feed_stream``."""

    def __init__(
        self,
        spark: SparkSession,
        sink,
        path: str,
        station_bound: int | None = None,
        spike_window: str = C.CANCELLATION_SPIKE_WINDOW,
        clean: "IncrementalClean | None" = None,
    ):
        """``clean``: an ``IncrementalClean`` run before this step; its tables
        are then the deduplicated history (no re-deduplication here)."""
        super().__init__(spark, sink, path)
        self.path = path.rstrip("/")
        self.station_bound = station_bound
        self.spike_window = spike_window
        self.clean = clean
        self.outliers = None if clean is None else OutlierState(spark, path, clean, station_bound)

    def process(self, first: int, last: int) -> None:
        mv_table = self.sink.read_movements_with_batch(self.spark)
        cx_table = self.sink.read_cancellations_with_batch(self.spark)

        new_mv = self.sink.read_movements_with_batch(self.spark, since=first).filter(in_batches(first, last)).drop(BATCH_COLUMN, DATE_COLUMN, "inserted_at")
        large = detect_large_delays(new_mv).withColumn("kind", F.lit(KIND_LARGE))
        spikes = self._touched_spikes(cx_table, first, last).withColumn("kind", F.lit(KIND_SPIKE))
        write_batch_partition(large.unionByName(spikes), self.path, last)

        if self.outliers is not None:
            outliers = self.outliers.fold(first, last)
        else:
            history = dedup.dedup_movements(mv_table.drop(BATCH_COLUMN, DATE_COLUMN)).drop("inserted_at")
            outliers = detect_station_delay_outliers(history, station_bound=self.station_bound)
        replace_snapshot(outliers, _outlier_path(self.path))
        prune_snapshots(self.spark, _outlier_path(self.path), older_than_seconds=SNAPSHOT_AGE_SECONDS)

    def _touched_spikes(self, cx_table: DataFrame, first: int, last: int) -> DataFrame:
        """Counts of every (station, bucket) the batches touched, over the deduplicated history.

        Counts below the threshold are kept too (score = count), so a later
        reader can see that a bucket no longer qualifies; they are dropped on read.
        """
        bucket = F.window(epoch_ms_to_ts("canx_timestamp"), self.spike_window).start
        touched = (
            cx_table.filter(in_batches(first, last))
            .select(F.col("local_name").alias("station"), bucket.alias("bucket"))
            .filter(F.col("station").isNotNull() & F.col("bucket").isNotNull())
            .distinct()
        )
        # Time range covered by the touched buckets, as epoch ms and as dates
        # (one small job); the dates prune the table's event_date partitions.
        span = touched.agg(
            ts_to_epoch_ms(F.min("bucket")).alias("lo_ms"),
            ts_to_epoch_ms(F.max(F.window("bucket", self.spike_window).end)).alias("end_ms"),
            F.to_date(F.min("bucket")).alias("lo_day"),
            F.to_date(F.max(F.window("bucket", self.spike_window).end)).alias("hi_day"),
        ).first()
        if span is None or span.lo_ms is None:
            return self.spark.createDataFrame([], ANOMALY_SCHEMA)
        in_span = (F.col(DATE_COLUMN).between(F.lit(span.lo_day), F.lit(span.hi_day))
                   & (F.col("canx_timestamp") >= span.lo_ms) & (F.col("canx_timestamp") < span.end_ms))
        if self.clean is not None:
            history = self.clean.history("cancellations").filter(in_span).drop(BATCH_COLUMN, DATE_COLUMN)
        else:
            history = cx_table.filter(in_span).drop(BATCH_COLUMN, DATE_COLUMN)
            history = dedup.dedup_cancellations(history).drop("inserted_at")
        keyed = history.withColumn("station", F.col("local_name")).withColumn("bucket", bucket)
        in_touched = join_small(keyed, touched, ["station", "bucket"], "left_semi").drop("station", "bucket")
        return detect_cancellation_spikes(in_touched, threshold=1, window=self.spike_window)


def read_incremental_anomalies(
    spark: SparkSession, path: str, threshold: int = C.CANCELLATION_SPIKE_THRESHOLD
) -> DataFrame:
    """Current anomalies from the incremental partitions (see module doc)."""
    schema = stored_schema(T.StructType(ANOMALY_SCHEMA.fields + [T.StructField("kind", T.StringType())]))
    rows = spark.read.schema(schema).parquet(path)
    large = dedup.dedup_anomalies(rows.filter(F.col("kind") == KIND_LARGE).select(*ANOMALY_COLUMNS))
    spikes = dedup.keep_first(
        rows.filter(F.col("kind") == KIND_SPIKE), ["local_name", "event_timestamp"], [-F.col(BATCH_COLUMN)]
    ).filter(F.col("anomaly_score") >= threshold)
    outliers = read_snapshot(spark, _outlier_path(path))
    return large.unionByName(spikes.select(*ANOMALY_COLUMNS)).unionByName(outliers.select(*ANOMALY_COLUMNS))
