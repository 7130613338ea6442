"""Report job (§3.3): every dashboard result as a small table.

Inputs are the fact tables as read (epoch-ms times), the anomaly table and
the coordinate dimension. The deduplicated, prepared facts are kept while the
report is computed, since most results read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from signalbox import constants as C
from signalbox.functions.columns import to_ts_ntz
from signalbox.operators import dedup, stats, station_map as smap, timeseries as ts
from signalbox.operators import transforms as tf
from signalbox.session import checkpoint_base


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    Every report frame reads the prepared facts; without this each frame would
    re-run the deduplication shuffle. A reliable checkpoint (not a local one)
    survives lost executors and cuts the lineage.
    """
    checkpoint_base(df.sparkSession)
    return df.checkpoint(eager=True)


def prepare_movements(table: DataFrame) -> DataFrame:
    """C-01: dedup (D-03), ``delay_minutes``, time as timestamp."""
    return tf.with_delay_minutes(tf.with_event_time(dedup.dedup_movements(table), "actual_timestamp"))


def prepare_cancellations(table: DataFrame) -> DataFrame:
    """C-02: dedup (D-04), time as timestamp."""
    return tf.with_event_time(dedup.dedup_cancellations(table), "canx_timestamp")


def prepare_abnormal_events(table: DataFrame) -> DataFrame:
    """C-03: time parsed (bad -> null), then dedup (D-05)."""
    dtype = dict(table.dtypes).get("event_timestamp", "timestamp_ntz")
    parsed = table.withColumn("event_timestamp", to_ts_ntz("event_timestamp", dtype))
    return dedup.dedup_anomalies(parsed)


def build_report(
    movements: DataFrame,
    cancellations: DataFrame,
    anomalies: DataFrame,
    coordinates: DataFrame,
    bucket: str = "1h",
    abnormal_min: int = C.DEFAULT_ABNORMAL_MAP_MIN,
    station_bound: int | None = None,
    materialized: bool = True,
) -> dict[str, DataFrame]:
    """All dashboard frames; ``bucket`` is one of ``10min``, ``1h``, ``1D``.

    With ``materialized`` (default) the prepared facts and anomalies are
    written once to the checkpoint folder before the frames are built.
    """
    duration = C.TIME_BUCKETS[bucket]
    mv = prepare_movements(movements)
    cx = prepare_cancellations(cancellations)
    ab = prepare_abnormal_events(anomalies)
    if materialized:
        mv, cx, ab = materialize(mv), materialize(cx), materialize(ab)
    station_mv = tf.filter_station_rows(mv)
    station_ab = tf.filter_station_rows(ab)
    map_rows = smap.station_map(station_mv, coordinates, ab, station_bound=station_bound)
    late = stats.late_movements(mv)
    return {
        "kpis": stats.dashboard_kpis(mv, cx, ab),
        "station_map": map_rows,
        "abnormal_map": smap.abnormal_map(map_rows, abnormal_min),
        "status_distribution": stats.status_distribution(mv),
        "top_delayed_stations": stats.top_delayed(station_mv),
        "top_avg_delay_stations": stats.top_avg_delay(station_mv),
        "canx_reason_distribution": stats.reason_distribution(cx),
        "anomaly_type_distribution": stats.anomaly_type_distribution(ab),
        "top_abnormal_stations": stats.top_abnormal_stations(ab),
        "delays_over_time": ts.count_by_time(late, "actual_timestamp", "delay_count", duration),
        "cancellations_over_time": ts.count_by_time(cx, "canx_timestamp", "cancel_count", duration),
        "abnormal_over_time": ts.count_by_time(ab, "event_timestamp", "abnormal_count", duration),
        "preview_station_movements": stats.preview(station_mv, stats.MOVEMENT_ORDER),
        "preview_cancellations": stats.preview(cx, stats.CANCELLATION_ORDER),
        "preview_station_abnormal_events": stats.preview(station_ab, stats.ANOMALY_ORDER),
        "preview_station_map": stats.preview(map_rows, ["alpha3"]),
    }


def chart_report(movements: DataFrame, cancellations: DataFrame, materialized: bool = True) -> dict[str, DataFrame]:
    """C-06 / C-07: chart data over all movements and cancellations (deduplicated)."""
    mv = prepare_movements(movements)
    cx = prepare_cancellations(cancellations)
    if materialized:
        mv, cx = materialize(mv), materialize(cx)
    late = stats.late_movements(mv)
    return {
        "variation_status_distribution": stats.status_distribution(mv),
        "top_delayed_stations": stats.top_delayed(mv),
        "top_avg_delay_by_stations": stats.top_avg_delay(mv),
        "delay_over_time": ts.count_by_time_filled(late, "actual_timestamp", "delay_count", "1 hour"),
        "top_cancelled_stations": stats.top_cancelled(cx),
        "cancellation_reason_distribution": stats.reason_distribution(cx),
        "cancellations_over_time": ts.count_by_time_filled(cx, "canx_timestamp", "cancel_count", "1 hour"),
    }


def write_report(report: dict[str, DataFrame], path: str) -> None:
    """Materialise each report frame as its own Parquet table.

    Every frame is bounded by stations, buckets or a row limit; adaptive
    execution merges the small partitions before writing.
    """
    for name, df in report.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
