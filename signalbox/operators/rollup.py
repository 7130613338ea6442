"""Time buckets as a cascade (A-20, B-01 ... B-03): one scan of the facts for all rates.

``bucket_partials`` counts the facts once per 10-minute bucket and station.
Its rows are mergeable: partials of parts add up to those of the whole, and
buckets of an hour or a day are sums of 10-minute buckets. Delays are added
up as exact integers (microseconds), so means do not depend on how the facts
were cut. Every wider series is an aggregate over the partials, whose size is
bounded by buckets and stations and not by the number of facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox import constants as C
from signalbox.functions.columns import epoch_ms_to_ts, is_late_ci
from signalbox.operators.anomaly import MICROSECONDS, SUM
from signalbox.operators.timeseries import fill_buckets

BASE = C.STATION_WINDOW
COUNTS = ("movements", "late", "cancellations", "delays")
PARTIAL_SCHEMA = T.StructType(
    [T.StructField("bucket", T.TimestampNTZType()), T.StructField("station", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COUNTS]
    + [T.StructField("delay_us", T.DecimalType(38, 0))]
)


def _merged(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.sum(c).cast("long").alias(c) for c in COUNTS], F.sum("delay_us").cast(SUM).alias("delay_us"))


def bucket_partials(
    movements: DataFrame, cancellations: DataFrame, duration: str = BASE, by: tuple[str, ...] = ()
) -> DataFrame:
    """Per (bucket, station): movements, late ones, cancellations, and number and sum of the delays.

    Inputs carry epoch-ms times; rows without a time are left out, a null
    station is one of its own. Movements of equal time and station are
    combined before the shuffle, so a hot station or hour is no hot task.
    ``by``: further columns of both inputs to count by.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    us = F.round(F.col("delay_seconds") * 1e6).try_cast(MICROSECONDS)
    mv = movements.select(
        epoch_ms_to_ts("actual_timestamp").alias("time"), F.col("local_name").alias("station"),
        one.alias("movements"), F.when(is_late_ci("variation_status"), one).otherwise(none).alias("late"),
        none.alias("cancellations"), F.when(us.isNotNull(), one).otherwise(none).alias("delays"),
        us.cast(SUM).alias("delay_us"), *by,
    )
    cx = cancellations.select(
        epoch_ms_to_ts("canx_timestamp").alias("time"), F.col("local_name").alias("station"), none.alias("movements"),
        none.alias("late"), one.alias("cancellations"), none.alias("delays"), F.lit(None).cast(SUM).alias("delay_us"),
        *by,
    )
    rows = mv.unionByName(cx).filter(F.col("time").isNotNull())
    return _merged(rows, F.window("time", duration).start.alias("bucket"), "station", *by).select(
        *PARTIAL_SCHEMA.fieldNames(), *by)


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of several parts (batches) as one row per (bucket, station)."""
    return _merged(partials, "bucket", "station").select(*PARTIAL_SCHEMA.fieldNames())


def roll_up(partials: DataFrame, duration: str) -> DataFrame:
    """Partials of wider buckets; ``duration`` is a multiple of the partials' own."""
    return _merged(
        partials.withColumnRenamed("bucket", "time"), F.window("time", duration).start.alias("bucket"), "station"
    ).select(*PARTIAL_SCHEMA.fieldNames())


def count_over_time(partials: DataFrame, count: str, duration: str, time_col: str, count_col: str) -> DataFrame:
    """B-02: one of ``COUNTS`` per bucket of ``duration``, all stations; empty buckets are left out."""
    return (
        partials.filter(F.col(count) > 0)
        .groupBy(F.window("bucket", duration).start.alias(time_col))
        .agg(F.sum(count).cast("long").alias(count_col))
    )


def count_over_time_filled(partials: DataFrame, count: str, duration: str, time_col: str, count_col: str) -> DataFrame:
    """B-01: as ``count_over_time``, with empty buckets between the first and last as 0."""
    return fill_buckets(count_over_time(partials, count, duration, time_col, count_col), time_col, count_col, duration)


def window_stats(partials: DataFrame, duration: str = BASE) -> DataFrame:
    """A-20: per (window, station) event count, mean delay in minutes, cancellations."""
    rows = partials if duration == BASE else roll_up(partials, duration)
    mean = F.when(F.col("delays") > 0, F.col("delay_us").cast("double") / F.col("delays") / 60e6)
    return rows.select(
        F.col("bucket").alias("window_start"),
        (F.col("bucket") + F.expr(f"INTERVAL {duration}")).alias("window_end"), "station",
        (F.col("movements") + F.col("cancellations")).alias("event_count"), mean.alias("avg_delay"),
        F.col("cancellations").alias("cancellation_count"),
    )


def spike_counts(partials: DataFrame, threshold: int = C.CANCELLATION_SPIKE_THRESHOLD,
                 duration: str = C.CANCELLATION_SPIKE_WINDOW) -> DataFrame:
    """B-03: (station, bucket, cancel_count) of at least ``threshold`` cancellations; null stations are left out."""
    return (
        roll_up(partials.filter((F.col("cancellations") > 0) & F.col("station").isNotNull()), duration)
        .filter(F.col("cancellations") >= threshold)
        .select("station", "bucket", F.col("cancellations").alias("cancel_count"))
    )
