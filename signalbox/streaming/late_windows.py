"""Rows behind the watermark: their windows are counted anew from the facts (T-05).

The watermarked window stream drops a row whose window it has closed. This
step runs beside it, on the rows as they were written: whatever rows a range
of batches brought for a window that the stream may have closed by then make
that window *dirty*. Dirty windows are listed per batch (``<path>/_dirty``)
and counted anew over all facts of their days; the counts go to
``<path>/_late`` and stand above those of the stream (``read_window_stats``).

Which windows the stream may have closed: its watermark never passes the
latest event time of all rows up to and including a row's own batch, less the
delay. The step takes that time as its clock, so every row that the stream can
have dropped makes its window dirty, whatever the two queries' batches are.
The clock only moves forward, so each later row of a corrected window
corrects it again: the newest correction is complete.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalbox.constants import STATION_WINDOW, WINDOW_TRIGGER_INTERVAL
from signalbox.operators.dedup import dedup_cancellations_on_write, dedup_movements_on_write
from signalbox.operators.joins import join_small
from signalbox.operators.timeseries import station_window_stats, window_events
from signalbox.sinks.writers import (
    BATCH_COLUMN,
    DATE_COLUMN,
    WINDOW_RESULT_STORED,
    late_windows_path,
    write_batch_partition,
)
from signalbox.streaming.progress import BatchStep, in_batches
from signalbox.streaming.state import VersionedState

CLOCK_SCHEMA = T.StructType([T.StructField("latest", T.TimestampNTZType())])
#: Dirty days are named one by one in the scan's partition filter up to this many, else by their range.
LISTED_DAYS = 400


class FeedEvents:
    """Window events of the feed, from the clean tables of an ``IncrementalClean``."""

    def __init__(self, clean):
        self.clean = clean

    def added(self, first: int, last: int) -> DataFrame:
        return window_events(self.clean.added("movements", first, last), self.clean.added("cancellations", first, last))

    def within(self, days: Column) -> DataFrame:
        """Events of the days, each message once (the write-time keys, as in the stream)."""
        kinds = {"movements": dedup_movements_on_write, "cancellations": dedup_cancellations_on_write}
        return window_events(*(
            once(self.clean.history(kind).filter(days).drop(BATCH_COLUMN, DATE_COLUMN)) for kind, once in kinds.items()))


class EventFacts:
    """Window events as landed by ``start_event_landing``."""

    SCHEMA = T.StructType([
        T.StructField("event_time", T.TimestampNTZType()), T.StructField("station", T.StringType()),
        T.StructField("delay_minutes", T.DoubleType()), T.StructField("is_cancelled", T.IntegerType()),
        T.StructField(DATE_COLUMN, T.DateType()), T.StructField(BATCH_COLUMN, T.LongType()),
    ])

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def write(self, events: DataFrame, batch_id: int) -> None:
        """One batch of events; writing it again replaces it."""
        rows = events.select(*[F.col(f.name).cast(f.dataType) for f in self.SCHEMA.fields[:4]])
        (
            rows.withColumn(DATE_COLUMN, F.to_date("event_time")).withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(DATE_COLUMN, BATCH_COLUMN).parquet(self.path)
        )

    def _all(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def added(self, first: int, last: int) -> DataFrame:
        return self._all().filter(in_batches(first, last)).drop(BATCH_COLUMN, DATE_COLUMN)

    def within(self, days: Column) -> DataFrame:
        return self._all().filter(days).drop(BATCH_COLUMN, DATE_COLUMN)


class LateWindows(BatchStep):
    """``after_write`` step: corrects the windows of rows that came behind the watermark."""

    READERS = ()

    def __init__(self, spark: SparkSession, source, path: str, watermark: str, duration: str = STATION_WINDOW, then=None):
        """``path``: the window stream's table; ``watermark``, ``duration``: as in the stream."""
        super().__init__(spark, None, late_windows_path(path), then)
        self.source = source
        self.path = path.rstrip("/")
        self.watermark = watermark
        self.duration = duration
        self.clock = VersionedState(spark, f"{self.path}/_clock", CLOCK_SCHEMA)

    def dirty(self, first: int, last: int) -> DataFrame:
        """(window_start, window_end, station) of the batches' rows whose windows may be closed."""
        rows = self.source.added(first, last).filter(F.col("event_time").isNotNull())
        clock = self.clock.write(
            self.clock.before(first).unionByName(rows.select(F.col("event_time").cast("timestamp_ntz").alias("latest")))
            .agg(F.max("latest").alias("latest")), last)
        latest = clock.first().latest
        if latest is None:
            latest = F.lit(None).cast("timestamp_ntz")
        window = F.window("event_time", self.duration)
        return (
            rows.select(window.alias("w"), "station")
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "station")
            .filter(F.col("window_end") <= F.lit(latest) - F.expr(f"INTERVAL {self.watermark}"))
            .distinct()
        )

    def process(self, first: int, last: int) -> None:
        columns = ["window_start", "window_end", "station"]
        write_batch_partition(self.dirty(first, last), f"{self.path}/_dirty", last)
        listed = self.spark.read.parquet(f"{self.path}/_dirty").filter(F.col(BATCH_COLUMN) == last).select(*columns)
        # The days that the windows touch.
        to = F.to_date(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND"))
        days = listed.select(F.explode(F.sequence(F.to_date("window_start"), to)).alias("day")).distinct()
        found = [r.day for r in days.limit(LISTED_DAYS + 1).collect()]
        if not found:
            return
        if len(found) > LISTED_DAYS:
            lo, hi = days.agg(F.min("day"), F.max("day")).first()
            touched = F.col(DATE_COLUMN).between(F.lit(lo), F.lit(hi))
        else:
            touched = F.col(DATE_COLUMN).isin(found)
        events = self.source.within(touched)
        keyed = events.withColumn("w", F.window("event_time", self.duration).start)
        wanted = listed.select(F.col("window_start").alias("d_start"), F.col("station").alias("d_station"))
        same = reduce(lambda a, b: a & b, [
            F.col("w") == F.col("d_start"), F.col("station").eqNullSafe(F.col("d_station"))])
        counted = station_window_stats(join_small(keyed, wanted, same, "left_semi").drop("w"), self.duration)
        write_batch_partition(
            counted.select(*[F.col(f.name).cast(f.dataType) for f in WINDOW_RESULT_STORED.fields]),
            late_windows_path(self.path), last)


def start_event_landing(
    events: DataFrame,
    facts: EventFacts,
    checkpoint_dir: str,
    after_write=None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Land a stream of window events as facts, and run ``after_write`` (``LateWindows``) on each batch."""
    def land(df: DataFrame, batch_id: int) -> None:
        facts.write(df, batch_id)
        if after_write is not None:
            after_write(batch_id)

    return (
        events.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or {"processingTime": WINDOW_TRIGGER_INTERVAL}))
        .start()
    )
