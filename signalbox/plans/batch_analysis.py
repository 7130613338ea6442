"""Batch analysis job (C-05): read messages, split, enrich, report, write.

Parsing happens once; the enriched facts are kept for the duration of the
report (several statistics read them) and released afterwards.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from signalbox import constants as C
from signalbox.operators import stats, transforms as tf
from signalbox.operators.joins import row_bound


def statistics(cancellations: DataFrame, delay_with_location: DataFrame) -> dict[str, DataFrame]:
    """C-05: the console statistics as DataFrames (callers show or store them)."""
    return {
        "canx_preview": stats.preview(cancellations, stats.CANCELLATION_ORDER, C.STATISTICS_ROWS),
        "movement_preview": stats.preview(delay_with_location, stats.MOVEMENT_ORDER, C.STATISTICS_ROWS),
        "delay_preview": stats.preview(tf.delay_info(delay_with_location), [], C.STATISTICS_ROWS),
        "canx_by_reason": stats.count_by(cancellations, "canx_reason_code"),
        "canx_by_location": stats.count_by(cancellations, "local_name"),
        "movements_by_status": stats.count_by(delay_with_location, "variation_status"),
        "delay_info": tf.delay_info(delay_with_location),
        "delays_by_event_type": stats.count_by(delay_with_location, "event_type"),
        "location_status_counts": stats.count_by(delay_with_location, "local_name", "variation_status"),
        "late_by_location": stats.late_by_location(delay_with_location),
        "late_delay_by_location": stats.late_delay_by_location(delay_with_location),
    }


def run_batch_analysis(feed: DataFrame, location_dim: DataFrame, sink=None, batch_id: int = 0):
    """§3.2 flow. Returns the statistics frames (already computed into cache).

    ``feed`` is the parsed message frame (``read_feed``). With a ``sink``,
    the facts are written as batch ``batch_id``.
    """
    dim_rows = row_bound(location_dim)
    feed = feed.persist(StorageLevel.MEMORY_AND_DISK)
    delay = tf.add_location_names(tf.calculate_delay(tf.extract_movements(feed)), location_dim, dim_rows)
    cancellations = tf.add_location_names(tf.extract_cancellations(feed), location_dim, dim_rows)
    delay = delay.persist(StorageLevel.MEMORY_AND_DISK)
    cancellations = cancellations.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        result = {name: df.persist(StorageLevel.MEMORY_AND_DISK) for name, df in statistics(cancellations, delay).items()}
        for df in result.values():
            df.count()
        if sink is not None:
            sink.write(delay, cancellations, batch_id)
    finally:
        delay.unpersist()
        cancellations.unpersist()
        feed.unpersist()
    return result
