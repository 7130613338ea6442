"""Anomaly detection (A-14, X-01 ... X-04, U-01).

All detectors take deduplicated fact tables (epoch-ms times) and return rows
of the anomaly schema (``ANOMALY_COLUMNS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalbox import constants as C
from signalbox.functions.columns import epoch_ms_to_ts, safe_double
from signalbox.operators.joins import join_small
from signalbox.schemas import ANOMALY_SCHEMA


# Delays are added up as whole microseconds; 38 digits hold the squares of any real table.
MICROSECONDS = "decimal(18,0)"
SUM = "decimal(38,0)"


def _anomaly_row(**cols: Column) -> list[Column]:
    """Columns in anomaly-schema order; unspecified ones are typed nulls."""
    out = []
    for field in ANOMALY_SCHEMA.fields:
        c = cols.get(field.name, F.lit(None))
        out.append(c.cast(field.dataType).alias(field.name))
    return out


def detect_large_delays(
    movements: DataFrame, threshold_seconds: float = C.DELAY_THRESHOLD_SECONDS
) -> DataFrame:
    """X-01: delay >= threshold; score = delay. Rows without location are kept."""
    delay = safe_double("delay_seconds")
    hits = movements.withColumn("delay_seconds", delay).filter(F.col("delay_seconds") >= threshold_seconds)
    return hits.select(
        *_anomaly_row(
            event_source=F.lit(C.EVENT_SOURCE_MOVEMENT),
            train_id=F.col("train_id"),
            alpha3=F.col("alpha3"),
            loc_stanox=F.col("loc_stanox"),
            local_name=F.col("local_name"),
            event_type=F.col("event_type"),
            event_timestamp=epoch_ms_to_ts("actual_timestamp"),
            delay_seconds=F.col("delay_seconds"),
            anomaly_type=F.lit(C.ANOMALY_LARGE_DELAY),
            anomaly_score=F.col("delay_seconds"),
            explanation=F.lit(C.EXPLANATION_LARGE_DELAY),
        )
    )


def timed_delays(movements: DataFrame) -> DataFrame:
    """Rows with a station and a delay (a number), and the delay in whole microseconds."""
    return (
        movements.withColumn("delay_seconds", safe_double("delay_seconds"))
        .withColumn("delay_us", F.round(F.col("delay_seconds") * 1e6).try_cast(MICROSECONDS))
        .filter(F.col("delay_us").isNotNull() & F.col("local_name").isNotNull())
    )


def station_delay_moments(movements: DataFrame) -> DataFrame:
    """Per station: number, sum and sum of squares of the delays in microseconds.

    The sums are exact integers, so they do not depend on the order of the
    rows, and moments of parts add up to the moments of the whole.
    """
    us = F.col("delay_us")
    return timed_delays(movements).groupBy("local_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(us).cast(SUM).alias("total"),
        F.sum(us * us).cast(SUM).alias("squares"),
    )


def stats_of_moments(moments: DataFrame) -> DataFrame:
    """``moments`` with the mean and the sample standard deviation in seconds.

    With q the integer part of the mean, the squared distances from q are an
    exact integer; only the remainder (less than one microsecond of mean) is
    settled in floating point. Equal delays therefore have deviation 0, and
    equal moments give equal digits.
    """
    q = F.expr("total div n").cast("decimal(20,0)")
    apart = (F.col("squares") - (q * F.col("total") * 2).cast(SUM) + (q * q * F.col("n")).cast(SUM)).cast("double")
    rest = (F.col("total") - (q * F.col("n")).cast(SUM)).cast("double")
    variance = (apart - rest * rest / F.col("n")) / (F.col("n") - 1)
    return moments.withColumn("mean", F.col("total").cast("double") / F.col("n") / 1e6).withColumn(
        "std", F.when(F.col("n") > 1, F.sqrt(variance) / 1e6)
    )


def station_delay_stats(movements: DataFrame) -> DataFrame:
    """A-14: per-station mean, sample standard deviation and count of delays.

    Rows without delay or station are left out; a station with one sample has
    a null deviation.
    """
    return stats_of_moments(station_delay_moments(movements)).select("local_name", "mean", "std", "n")


def detect_station_delay_outliers(
    movements: DataFrame,
    z_threshold: float = C.Z_SCORE_THRESHOLD,
    min_samples: int = C.MIN_STATION_SAMPLES,
    station_bound: int | None = None,
) -> DataFrame:
    """X-02: delays at least ``z_threshold`` deviations above the station mean.

    Statistics cover the station's whole history including the row itself.
    They are computed by an aggregate (partial per partition, so a busy
    station is combined before the shuffle) and joined back on the station;
    the statistics frame has one row per station and is broadcast when its
    size is within the bound. ``station_bound`` is a known upper bound on the
    number of stations (the row count of the checked location dimension the
    names come from); without it the statistics are counted first. Only
    stations with deviation > 0 and at least ``min_samples`` samples are
    scored.
    """
    return score_outliers(movements, station_delay_stats(movements), z_threshold, min_samples, station_bound)


def score_outliers(
    movements: DataFrame,
    stats: DataFrame,
    z_threshold: float = C.Z_SCORE_THRESHOLD,
    min_samples: int = C.MIN_STATION_SAMPLES,
    station_bound: int | None = None,
) -> DataFrame:
    """X-02 against given statistics (local_name, mean, std, n) of the stations."""
    stats = stats.filter((F.col("std") > 0) & (F.col("n") >= min_samples)).select("local_name", "mean", "std")
    scored = join_small(
        timed_delays(movements), stats, "local_name", "inner", known_rows=station_bound
    ).withColumn("z_score", (F.col("delay_seconds") - F.col("mean")) / F.col("std"))
    hits = scored.filter(F.col("z_score") >= z_threshold)
    return hits.select(
        *_anomaly_row(
            event_source=F.lit(C.EVENT_SOURCE_MOVEMENT),
            train_id=F.col("train_id"),
            alpha3=F.col("alpha3"),
            loc_stanox=F.col("loc_stanox"),
            local_name=F.col("local_name"),
            event_type=F.col("event_type"),
            event_timestamp=epoch_ms_to_ts("actual_timestamp"),
            delay_seconds=F.col("delay_seconds"),
            anomaly_type=F.lit(C.ANOMALY_STATION_OUTLIER),
            anomaly_score=F.col("z_score"),
            explanation=F.lit(C.EXPLANATION_STATION_OUTLIER),
        )
    )


def detect_cancellation_spikes(
    cancellations: DataFrame,
    threshold: int = C.CANCELLATION_SPIKE_THRESHOLD,
    window: str = C.CANCELLATION_SPIKE_WINDOW,
) -> DataFrame:
    """X-03: at least ``threshold`` cancellations at one station in one bucket.

    One row per (station, bucket); the station is the location name, or the
    location code when the table has no name column. Rows without station or
    time are left out.
    """
    station = "local_name" if "local_name" in cancellations.columns else "loc_stanox"
    counts = (
        cancellations.select(
            F.col(station).alias("station"), epoch_ms_to_ts("canx_timestamp").alias("event_timestamp")
        )
        .filter(F.col("station").isNotNull() & F.col("event_timestamp").isNotNull())
        .groupBy("station", F.window("event_timestamp", window).start.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("cancel_count"))
        .filter(F.col("cancel_count") >= threshold)
    )
    return counts.select(
        *_anomaly_row(
            event_source=F.lit(C.EVENT_SOURCE_CANCELLATION),
            local_name=F.col("station"),
            event_type=F.lit(C.CANCELLATION_SPIKE_EVENT_TYPE),
            event_timestamp=F.col("bucket"),
            anomaly_type=F.lit(C.ANOMALY_CANCELLATION_SPIKE),
            anomaly_score=F.col("cancel_count"),
            explanation=F.lit(C.EXPLANATION_CANCELLATION_SPIKE),
        )
    )


def detect_anomalies(
    movements: DataFrame, cancellations: DataFrame, station_bound: int | None = None
) -> DataFrame:
    """X-04 + U-01: all three detectors over deduplicated facts, as one frame."""
    return (
        detect_large_delays(movements)
        .unionByName(detect_station_delay_outliers(movements, station_bound=station_bound))
        .unionByName(detect_cancellation_spikes(cancellations))
    )
