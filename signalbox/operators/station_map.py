"""Station map rows (A-15, A-16, J-03, J-04, P-12 ... P-15, F-10, C-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox import constants as C
from signalbox.functions.columns import (
    abnormal_color,
    delay_color,
    has_text,
    marker_size,
    station_tooltip,
)
from signalbox.operators.joins import join_small
from signalbox.schemas import COORDINATE_SCHEMA


def station_stats(station_movements: DataFrame) -> DataFrame:
    """A-15: per station code: events, mean delay (minutes), delays >= 30 minutes."""
    return (
        station_movements.filter(F.col("alpha3").isNotNull())
        .groupBy("alpha3")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.avg("delay_minutes").alias("avg_delay"),
            F.count_if(F.col("delay_minutes") >= C.LARGE_DELAY_MINUTES).alias("large_delay_count"),
        )
    )


def station_abnormal_counts(anomalies: DataFrame) -> DataFrame:
    """A-16: anomalies per station code (station rows only)."""
    return (
        anomalies.filter(has_text("alpha3"))
        .groupBy("alpha3")
        .agg(F.count(F.lit(1)).alias("abnormal_count"))
    )


def station_map(
    station_movements: DataFrame,
    coordinates: DataFrame,
    anomalies: DataFrame,
    station_bound: int | None = None,
    coords_rows: int | None = None,
) -> DataFrame:
    """C-04: per-station map rows with coordinates, anomaly counts and styling.

    Station statistics are joined with coordinates (inner: stations without
    coordinates are not drawn) and anomaly counts (left: none -> 0). All
    three inputs are per-station frames; the coordinate and anomaly frames
    are broadcast when their size is within the bound (``station_bound``:
    known upper bound on station codes, e.g. rows of the checked location
    dimension; ``coords_rows``: checked size of the coordinate frame). With no movements the result is an empty frame with the full
    schema.
    """
    stats = station_stats(station_movements)
    coords = coordinates.select(*COORDINATE_SCHEMA.fieldNames())
    counts = station_abnormal_counts(anomalies)
    rows = join_small(stats, coords, "alpha3", "inner", known_rows=coords_rows)
    rows = join_small(rows, counts, "alpha3", "left", known_rows=station_bound)
    rows = rows.withColumn("avg_delay", F.coalesce(F.col("avg_delay"), F.lit(0.0))).withColumn(
        "abnormal_count", F.coalesce(F.col("abnormal_count"), F.lit(0)).cast("int")
    )
    return rows.select(
        "alpha3", "event_count", "avg_delay", "large_delay_count",
        "station_name", "latitude", "longitude", "abnormal_count",
        marker_size("event_count", C.MARKER_EVENT_CLIP, C.MARKER_EVENT_SCALE).alias("marker_size"),
        marker_size("abnormal_count", C.MARKER_ABNORMAL_CLIP, C.MARKER_ABNORMAL_SCALE).alias("abnormal_marker_size"),
        delay_color("avg_delay").alias("delay_color"),
        abnormal_color("abnormal_count").alias("abnormal_color"),
        station_tooltip(
            "station_name", "alpha3", "event_count", "avg_delay", "large_delay_count", "abnormal_count"
        ).alias("tooltip"),
    )


def abnormal_map(map_rows: DataFrame, min_count: int = C.DEFAULT_ABNORMAL_MAP_MIN) -> DataFrame:
    """F-10: stations with at least ``min_count`` anomalies."""
    return map_rows.filter(F.col("abnormal_count") >= min_count)
