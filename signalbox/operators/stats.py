"""Grouped statistics, distributions and rankings (A-01 ... A-13, A-17, A-18, O-*).

Every ranking ends with its key as a tie-break, so results are deterministic.
Counts and means are hash aggregates with a map-side partial step, so a hot
key is combined before the shuffle. Rankings use ``orderBy().limit()``, which
Spark plans as a per-partition top-k plus a final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox import constants as C
from signalbox.functions.columns import anomaly_label, has_text, is_late, is_late_ci, or_unknown


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """A-01 ... A-05: ``groupBy(keys).count()``; a null key is its own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def count_by_msg_type(feed: DataFrame) -> DataFrame:
    """A-01."""
    return feed.groupBy(F.col("header.msg_type").alias("msg_type")).agg(F.count(F.lit(1)).alias("count"))


def late_by_location(delay_df: DataFrame, n: int = C.STATISTICS_ROWS) -> DataFrame:
    """F-02 + O-01: locations with most late movements."""
    counts = count_by(delay_df.filter(is_late("variation_status")), "local_name")
    return counts.orderBy(F.desc("count"), F.asc_nulls_first("local_name")).limit(n)


def late_delay_by_location(delay_df: DataFrame, n: int = C.STATISTICS_ROWS) -> DataFrame:
    """A-06 + O-02: late count and mean delay per location, worst first."""
    agg = (
        delay_df.filter(is_late("variation_status"))
        .groupBy("local_name")
        .agg(F.count(F.lit(1)).alias("late_count"), F.avg("delay_seconds").alias("avg_delay_seconds"))
    )
    return agg.orderBy(F.desc_nulls_last("avg_delay_seconds"), F.asc_nulls_first("local_name")).limit(n)


def value_counts(df: DataFrame, column: str, label=None, n: int | None = None) -> DataFrame:
    """Distribution of a column with null -> ``unknown``; most frequent first."""
    key = (label or or_unknown)(column).alias(column)
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    ranked = counts.orderBy(F.desc("count"), F.asc(column))
    return ranked.limit(n) if n else ranked


def status_distribution(movements: DataFrame) -> DataFrame:
    """A-07."""
    return value_counts(movements, "variation_status")


def late_movements(movements: DataFrame) -> DataFrame:
    """F-03: case-insensitive late filter (null is not late)."""
    return movements.filter(is_late_ci("variation_status"))


def top_delayed(movements: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """A-08: late events per location, top ``n``."""
    return value_counts(late_movements(movements), "local_name", n=n)


def top_avg_delay(movements: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """A-09: mean delay in minutes per location (null location dropped), top ``n``."""
    agg = (
        movements.filter(F.col("delay_minutes").isNotNull() & F.col("local_name").isNotNull())
        .groupBy("local_name")
        .agg(F.avg("delay_minutes").alias("avg_delay_minutes"))
    )
    return agg.orderBy(F.desc("avg_delay_minutes"), F.asc("local_name")).limit(n)


def top_cancelled(cancellations: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """A-10."""
    return value_counts(cancellations, "local_name", n=n)


def reason_distribution(cancellations: DataFrame) -> DataFrame:
    """A-11."""
    return value_counts(cancellations, "canx_reason_code")


def anomaly_type_distribution(anomalies: DataFrame) -> DataFrame:
    """A-12: anomaly types under their display labels."""
    return value_counts(anomalies, "anomaly_type", label=anomaly_label)


def top_abnormal_stations(anomalies: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """A-13: anomalies per station (station rows only), top ``n``."""
    return value_counts(anomalies.filter(has_text("alpha3")), "local_name", n=n)


def avg_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """A-18: mean of a numeric column per key."""
    return df.groupBy(key).agg(F.avg(value).alias(f"avg_{value}"))


def dashboard_kpis(movements: DataFrame, cancellations: DataFrame, anomalies: DataFrame) -> DataFrame:
    """A-17: one row of headline numbers.

    The three inputs are tagged and unioned, then reduced by one global
    aggregate (partial per partition, one tiny final merge) instead of
    joining separate one-row results.
    """
    station = has_text("alpha3")
    mv = movements.select(
        F.lit(1).alias("kind"),
        station.alias("is_station"),
        is_late_ci("variation_status").alias("is_late"),
        F.col("delay_minutes").cast("double").alias("delay_minutes"),
    )
    cx = cancellations.select(F.lit(2).alias("kind"))
    ab = anomalies.select(F.lit(3).alias("kind"), station.alias("is_station"))
    tagged = mv.unionByName(cx, allowMissingColumns=True).unionByName(ab, allowMissingColumns=True)
    kind = F.col("kind")
    st = F.coalesce(F.col("is_station"), F.lit(False))
    return tagged.agg(
        F.count_if(kind == 1).alias("movement_events"),
        F.count_if((kind == 1) & st & F.col("is_late")).alias("station_delayed_events"),
        F.count_if(kind == 2).alias("cancellation_events"),
        F.count_if((kind == 3) & st).alias("station_abnormal_events"),
        F.avg(F.when((kind == 1) & st, F.col("delay_minutes"))).alias("avg_station_delay"),
    )


# First columns of the previews' orders; all other columns follow.
MOVEMENT_ORDER = ["actual_timestamp", "train_id", "loc_stanox", "event_type", "planned_timestamp"]
CANCELLATION_ORDER = ["canx_timestamp", "train_id", "loc_stanox", "train_service_code", "toc_id", "canx_type"]
ANOMALY_ORDER = ["event_timestamp", "local_name", "train_id", "anomaly_type"]


def preview(df: DataFrame, first: list[str], rows: int = C.PREVIEW_ROWS) -> DataFrame:
    """O-07 / K-08: the first ``rows`` rows by ``first`` and then all other columns (nulls first)."""
    order = first + [c for c in df.columns if c not in first]
    return df.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(rows)
