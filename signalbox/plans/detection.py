"""Anomaly detection job (X-04 + K-04).

Reads both fact tables, removes replayed rows (D-03, D-04), runs the three
detectors and replaces the anomaly table with a complete new snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalbox.operators import dedup
from signalbox.operators.anomaly import detect_anomalies
from signalbox.sinks.writers import prune_snapshots, replace_snapshot


def detect_from_tables(spark: SparkSession, sink, station_bound: int | None = None) -> DataFrame:
    movements = dedup.dedup_movements(sink.read_movements(spark))
    cancellations = dedup.dedup_cancellations(sink.read_cancellations(spark))
    drop = [c for c in ("inserted_at",) if c in movements.columns]
    movements = movements.drop(*drop)
    cancellations = cancellations.drop(*[c for c in ("inserted_at",) if c in cancellations.columns])
    return detect_anomalies(movements, cancellations, station_bound=station_bound)


def run_detection(
    spark: SparkSession, sink, anomaly_path: str, station_bound: int | None = None, keep: int = 3
) -> str:
    """Detect over the whole tables, publish a new anomaly snapshot, and keep
    only the newest ``keep`` snapshots."""
    version = replace_snapshot(detect_from_tables(spark, sink, station_bound), anomaly_path)
    prune_snapshots(spark, anomaly_path, keep)
    return version
