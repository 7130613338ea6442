"""Time buckets and event-time windows (A-19, A-20, B-01 ... B-03).

Buckets are epoch-aligned tumbling windows on ``timestamp_ntz`` values, so
they start at UTC midnight and do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox import constants as C
from signalbox.functions.columns import epoch_ms_to_ts, epoch_ntz


def count_by_time(df: DataFrame, time_col: str, count_col: str, duration: str) -> DataFrame:
    """B-02: rows per non-empty bucket; the bucket start keeps the time column's name."""
    return (
        df.filter(F.col(time_col).isNotNull())
        .groupBy(F.window(time_col, duration).start.alias(time_col))
        .agg(F.count(F.lit(1)).alias(count_col))
    )


def count_by_time_filled(
    df: DataFrame, time_col: str, count_col: str, duration: str, chunk: int = 1024
) -> DataFrame:
    """B-01: rows per bucket with empty buckets between the first and last as 0.

    The bucket spine (one row per bucket in the covered span) is generated in
    two levels so that no task produces it whole: one row per ``chunk``
    buckets, spread over the cluster, then each row expands to its buckets.
    It is joined with the per-bucket counts; both are bounded by the span,
    not by the number of input rows.
    """
    return fill_buckets(count_by_time(df, time_col, count_col, duration), time_col, count_col, duration, chunk)


def fill_buckets(counts: DataFrame, time_col: str, count_col: str, duration: str, chunk: int = 1024) -> DataFrame:
    """``counts`` (one row per non-empty bucket) with the empty buckets between as 0; see ``count_by_time_filled``."""
    epoch = epoch_ntz()
    step_us = F.timestamp_diff("MICROSECOND", epoch, epoch + F.expr(f"INTERVAL {duration}"))
    lo_us = F.timestamp_diff("MICROSECOND", epoch, F.col("lo"))
    hi_us = F.timestamp_diff("MICROSECOND", epoch, F.col("hi"))
    span = counts.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).filter(F.col("lo").isNotNull())
    span = span.select(lo_us.alias("lo_us"), ((hi_us - lo_us) / step_us).cast("long").alias("last"),
                       step_us.alias("step_us"))
    coarse = span.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / F.lit(chunk)))).alias("c")
    ).repartition(counts.sparkSession.sparkContext.defaultParallelism)
    first = F.col("c") * chunk
    fine = coarse.select(
        "lo_us", "step_us",
        F.explode(F.sequence(first, F.least(first + (chunk - 1), F.col("last")))).alias("i"),
    )
    spine = fine.select(
        F.timestamp_add("MICROSECOND", F.col("lo_us") + F.col("i") * F.col("step_us"), epoch).alias(time_col)
    )
    return spine.join(counts, time_col, "left").select(
        time_col, F.coalesce(F.col(count_col), F.lit(0)).cast("long").alias(count_col)
    )


def window_events(movements: DataFrame, cancellations: DataFrame) -> DataFrame:
    """A-20 input: one event stream of movements and cancellations.

    Movements: (actual time, location, delay in minutes, 0); cancellations:
    (cancellation time, location, null, 1). Inputs carry epoch-ms times.
    """
    def event_time(df: DataFrame, ms_col: str):
        # A stream carries its watermarked ``event_time``; keep that column.
        return F.col("event_time") if "event_time" in df.columns else epoch_ms_to_ts(ms_col).alias("event_time")

    mv = movements.select(
        event_time(movements, "actual_timestamp"),
        F.col("local_name").alias("station"),
        (F.col("delay_seconds") / F.lit(60.0)).alias("delay_minutes"),
        F.lit(0).alias("is_cancelled"),
    )
    cx = cancellations.select(
        event_time(cancellations, "canx_timestamp"),
        F.col("local_name").alias("station"),
        F.lit(None).cast("double").alias("delay_minutes"),
        F.lit(1).alias("is_cancelled"),
    )
    return mv.unionByName(cx)


def station_window_stats(events: DataFrame, duration: str = C.STATION_WINDOW) -> DataFrame:
    """A-20 / P-16: per (tumbling window, station) event count, mean delay, cancellations."""
    return (
        events.groupBy(F.window("event_time", duration).alias("window"), F.col("station"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.avg("delay_minutes").alias("avg_delay"),
            F.sum("is_cancelled").cast("long").alias("cancellation_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "station", "event_count", "avg_delay", "cancellation_count",
        )
    )


def window_station_delay(window_stats: DataFrame) -> DataFrame:
    """A-19: unweighted mean of window means per station, highest first."""
    return (
        window_stats.filter(F.col("station").isNotNull())
        .groupBy("station")
        .agg(F.avg("avg_delay").alias("avg_delay"))
        .orderBy(F.desc_nulls_last("avg_delay"), F.asc("station"))
    )


def window_station_cancels(window_stats: DataFrame) -> DataFrame:
    """A-19: cancellations per station, highest first."""
    return (
        window_stats.filter(F.col("station").isNotNull())
        .groupBy("station")
        .agg(F.sum("cancellation_count").cast("long").alias("cancellation_count"))
        .orderBy(F.desc("cancellation_count"), F.asc("station"))
    )


def window_event_totals(window_stats: DataFrame) -> DataFrame:
    """A-19: events per window start, in time order."""
    return (
        window_stats.groupBy("window_start")
        .agg(F.sum("event_count").cast("long").alias("event_count"))
        .orderBy("window_start")
    )
