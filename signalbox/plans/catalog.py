"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the provided tables whole and runs the library operator on
the derived feed. Means, deviations and scores are rounded to 4 places and
times are ``timestamp_ntz`` so results compare exactly with the SQL oracle in
``signalbox.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbox import constants as C
from signalbox.operators import anomaly, dedup, rollup, stats, station_map as smap, timeseries as ts
from signalbox.operators import transforms as tf
from signalbox.plans import batch_analysis, report
from signalbox.plans.inputs import Inputs
from signalbox.sources import feed as feed_src

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _r4(df: DataFrame, *cols: str) -> DataFrame:
    """Round to 4 places for comparison with the SQL oracle.

    The value is nudged 1e-9 away from zero first: two engines summing the
    same doubles in a different order can land an exact half (e.g. 17.31625)
    on either side, and the nudge is far above that noise and far below the
    4th decimal.
    """
    for c in cols:
        x = F.col(c)
        df = df.withColumn(c, F.round(x + F.signum(x) * F.lit(1e-9), 4))
    return df


# --- sources / parsing ------------------------------------------------------

@query
def feed_parse(spark, sf_dir):
    """S-01/S-03: message text parsed with the fixed schema, all leaves flattened."""
    landed = Inputs(spark, sf_dir).landed
    parsed = feed_src.parse_feed_text(feed_src.read_message_lines(spark, landed.text_path))
    return tf.flatten_feed(parsed)


@query
def feed_quarantine(spark, sf_dir):
    """S-11: good vs corrupt message text."""
    landed = Inputs(spark, sf_dir).landed
    frames = feed_src.read_message_lines(spark, [landed.text_path, landed.cut_text_path])
    return feed_src.quarantine_counts(frames)


@query
def feed_header_preview(spark, sf_dir):
    """P-04 + K-08: first rows of the header projection."""
    hp = tf.header_preview(Inputs(spark, sf_dir).feed)
    return hp.orderBy("msg_type", "queue_timestamp", "source_system_id").limit(C.STATISTICS_ROWS)


@query
def count_by_msg_type(spark, sf_dir):
    """A-01."""
    return stats.count_by_msg_type(Inputs(spark, sf_dir).feed)


@query
def extract_movements(spark, sf_dir):
    """P-02."""
    return tf.extract_movements(Inputs(spark, sf_dir).feed)


@query
def extract_cancellations(spark, sf_dir):
    """P-01."""
    return tf.extract_cancellations(Inputs(spark, sf_dir).feed)


@query
def calculate_delay(spark, sf_dir):
    """P-03."""
    return tf.calculate_delay(tf.extract_movements(Inputs(spark, sf_dir).feed))


@query
def delay_info(spark, sf_dir):
    """P-05."""
    return tf.delay_info(Inputs(spark, sf_dir).mv)


@query
def location_dim(spark, sf_dir):
    """S-05 / D-06."""
    return Inputs(spark, sf_dir).dim


@query
def station_coordinates(spark, sf_dir):
    """S-06 / D-07."""
    return Inputs(spark, sf_dir).coords


@query
def enrich_movements(spark, sf_dir):
    """J-01 on movements with delay."""
    return Inputs(spark, sf_dir).mv


@query
def enrich_cancellations(spark, sf_dir):
    """J-01 on cancellations."""
    return Inputs(spark, sf_dir).cx


# --- write-time and read-time dedup -----------------------------------------

@query
def movement_output(spark, sf_dir):
    """K-02: movement table rows with write-time dedup (D-01)."""
    return dedup.dedup_movements_on_write(Inputs(spark, sf_dir).mv_rows2)


@query
def cancellation_output(spark, sf_dir):
    """K-03: cancellation table rows with write-time dedup (D-02)."""
    return dedup.dedup_cancellations_on_write(Inputs(spark, sf_dir).cx_rows2)


@query
def dedup_movements(spark, sf_dir):
    """D-03 on the movement table (replayed batches included)."""
    return Inputs(spark, sf_dir).dedup_mv_table()


@query
def dedup_cancellations(spark, sf_dir):
    """D-04 on the cancellation table."""
    return Inputs(spark, sf_dir).dedup_cx_table()


@query
def prepare_movements(spark, sf_dir):
    """C-01 on the movement table."""
    i = Inputs(spark, sf_dir)
    return i.prepare_mv(i.dedup_mv_table())


@query
def prepare_cancellations(spark, sf_dir):
    """C-02 on the cancellation table."""
    i = Inputs(spark, sf_dir)
    return i.prepare_cx(i.dedup_cx_table())


@query
def prepare_abnormal_events(spark, sf_dir):
    """C-03 + P-08: anomaly rows with text times, parsed and deduplicated on the anomaly key.

    Every row is delivered twice; large delays come a third time with a text
    that is no time, which gives null.
    """
    ab = Inputs(spark, sf_dir).ab
    text = ab.withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    bad = text.filter(F.col("anomaly_type") == C.ANOMALY_LARGE_DELAY).withColumn("event_timestamp", F.lit("n/a"))
    return _r4(report.prepare_abnormal_events(text.unionByName(text).unionByName(bad)), "anomaly_score")


# --- batch statistics (enriched facts of the feed) ---------------------------

@query
def canx_by_reason(spark, sf_dir):
    """A-02."""
    return stats.count_by(Inputs(spark, sf_dir).cx, "canx_reason_code")


@query
def canx_by_location(spark, sf_dir):
    """A-03."""
    return stats.count_by(Inputs(spark, sf_dir).cx, "local_name")


@query
def canx_by_stanox(spark, sf_dir):
    """A-03."""
    return stats.count_by(Inputs(spark, sf_dir).cx, "loc_stanox")


@query
def movements_by_status(spark, sf_dir):
    """A-04."""
    return stats.count_by(Inputs(spark, sf_dir).mv, "variation_status")


@query
def delays_by_event_type(spark, sf_dir):
    """A-04."""
    return stats.count_by(Inputs(spark, sf_dir).mv, "event_type")


@query
def location_status_counts(spark, sf_dir):
    """A-05."""
    return stats.count_by(Inputs(spark, sf_dir).mv, "local_name", "variation_status")


@query
def late_by_location(spark, sf_dir):
    """F-02 + O-01."""
    return stats.late_by_location(Inputs(spark, sf_dir).mv)


@query
def late_delay_by_location(spark, sf_dir):
    """A-06 + O-02 (flagship)."""
    return _r4(stats.late_delay_by_location(Inputs(spark, sf_dir).mv), "avg_delay_seconds")


# --- report distributions and rankings (deduplicated facts) -----------------

@query
def status_distribution(spark, sf_dir):
    """A-07."""
    return stats.status_distribution(Inputs(spark, sf_dir).mvd)


@query
def top_delayed_locations(spark, sf_dir):
    """A-08, all movements."""
    return stats.top_delayed(Inputs(spark, sf_dir).mvd)


@query
def top_delayed_stations(spark, sf_dir):
    """A-08, station movements."""
    return stats.top_delayed(Inputs(spark, sf_dir).station_mvd)


@query
def top_avg_delay_locations(spark, sf_dir):
    """A-09, all movements."""
    return _r4(stats.top_avg_delay(Inputs(spark, sf_dir).mvd), "avg_delay_minutes")


@query
def top_avg_delay_stations(spark, sf_dir):
    """A-09, station movements."""
    return _r4(stats.top_avg_delay(Inputs(spark, sf_dir).station_mvd), "avg_delay_minutes")


@query
def top_cancelled_locations(spark, sf_dir):
    """A-10."""
    return stats.top_cancelled(Inputs(spark, sf_dir).cxd)


@query
def canx_reason_distribution(spark, sf_dir):
    """A-11."""
    return stats.reason_distribution(Inputs(spark, sf_dir).cxd)


@query
def anomaly_type_distribution(spark, sf_dir):
    """A-12."""
    return stats.anomaly_type_distribution(Inputs(spark, sf_dir).ab)


@query
def top_abnormal_stations(spark, sf_dir):
    """A-13."""
    return stats.top_abnormal_stations(Inputs(spark, sf_dir).ab)


@query
def smoke_avg_by_key(spark, sf_dir):
    """A-18: mean delay (minutes) per location."""
    return _r4(stats.avg_by_key(Inputs(spark, sf_dir).mvd, "local_name", "delay_minutes"), "avg_delay_minutes")


@query
def dashboard_kpis(spark, sf_dir):
    """A-17."""
    i = Inputs(spark, sf_dir)
    return _r4(stats.dashboard_kpis(i.mvd, i.cxd, i.ab), "avg_station_delay")


@query
def station_movements(spark, sf_dir):
    """F-04."""
    return Inputs(spark, sf_dir).station_mvd


@query
def station_abnormal_events(spark, sf_dir):
    """F-05."""
    return _r4(tf.filter_station_rows(Inputs(spark, sf_dir).ab), "anomaly_score")


@query
def preview_station_movements(spark, sf_dir):
    """O-07: first station movements in time order."""
    return (
        Inputs(spark, sf_dir)
        .station_mvd.orderBy(F.asc_nulls_first("actual_timestamp"), F.asc_nulls_first("train_id"),
                             F.asc_nulls_first("loc_stanox"), F.asc_nulls_first("event_type"),
                             F.asc_nulls_first("planned_timestamp"))
        .limit(C.PREVIEW_ROWS)
    )


@query
def preview_cancellations(spark, sf_dir):
    """O-07: first cancellations in time order."""
    return stats.preview(Inputs(spark, sf_dir).cxd, stats.CANCELLATION_ORDER)


@query
def preview_station_abnormal_events(spark, sf_dir):
    """O-07: first station anomalies in time order."""
    station_ab = tf.filter_station_rows(Inputs(spark, sf_dir).ab)
    return _r4(stats.preview(station_ab, stats.ANOMALY_ORDER), "anomaly_score")


@query
def preview_station_map(spark, sf_dir):
    """O-07: first stations of the map."""
    return _flat_map(stats.preview(_station_map(Inputs(spark, sf_dir)), ["alpha3"]))


@query
def statistics_canx_preview(spark, sf_dir):
    """C-05 + K-08: first cancellations of the batch statistics."""
    i = Inputs(spark, sf_dir)
    return batch_analysis.statistics(i.cx, i.mv)["canx_preview"]


@query
def statistics_movement_preview(spark, sf_dir):
    """C-05 + K-08: first movements of the batch statistics."""
    i = Inputs(spark, sf_dir)
    return batch_analysis.statistics(i.cx, i.mv)["movement_preview"]


@query
def statistics_delay_preview(spark, sf_dir):
    """C-05 + K-08: first rows of the delay information."""
    i = Inputs(spark, sf_dir)
    return batch_analysis.statistics(i.cx, i.mv)["delay_preview"]


# --- anomalies --------------------------------------------------------------

@query
def station_delay_stats(spark, sf_dir):
    """A-14."""
    return _r4(anomaly.station_delay_stats(Inputs(spark, sf_dir).mvd_raw), "mean", "std")


@query
def large_delays(spark, sf_dir):
    """X-01."""
    return _r4(anomaly.detect_large_delays(Inputs(spark, sf_dir).mvd_raw), "anomaly_score")


@query
def station_delay_outliers(spark, sf_dir):
    """X-02."""
    i = Inputs(spark, sf_dir)
    return _r4(anomaly.detect_station_delay_outliers(i.mvd_raw, station_bound=i.dim_rows), "anomaly_score")


@query
def cancellation_spikes(spark, sf_dir):
    """X-03 (one-hour buckets)."""
    return anomaly.detect_cancellation_spikes(Inputs(spark, sf_dir).cxd_raw)


@query
def cancellation_spikes_daily(spark, sf_dir):
    """X-03 with one-day buckets."""
    return anomaly.detect_cancellation_spikes(Inputs(spark, sf_dir).cxd_raw, window="1 day")


@query
def cancellation_spikes_pairs(spark, sf_dir):
    """X-03 with the threshold lowered to two cancellations in an hour."""
    return anomaly.detect_cancellation_spikes(Inputs(spark, sf_dir).cxd_raw, threshold=2)


@query
def abnormal_events(spark, sf_dir):
    """X-04 + U-01 on the deduplicated facts."""
    return _r4(Inputs(spark, sf_dir).detect(), "anomaly_score")


# --- time series ------------------------------------------------------------

def _window_stats(i: Inputs) -> DataFrame:
    return ts.station_window_stats(ts.window_events(i.mvd_raw, i.cxd_raw))


@query
def station_window_stats(spark, sf_dir):
    """A-20."""
    return _r4(_window_stats(Inputs(spark, sf_dir)), "avg_delay")


@query
def window_station_delay(spark, sf_dir):
    """A-19 (mean of window means)."""
    return _r4(ts.window_station_delay(_window_stats(Inputs(spark, sf_dir))), "avg_delay")


@query
def window_station_cancels(spark, sf_dir):
    """A-19 (cancellations per station)."""
    return ts.window_station_cancels(_window_stats(Inputs(spark, sf_dir)))


@query
def window_event_totals(spark, sf_dir):
    """A-19 (events per window)."""
    return ts.window_event_totals(_window_stats(Inputs(spark, sf_dir)))


@query
def late_hourly_filled(spark, sf_dir):
    """B-01, late movements."""
    late = stats.late_movements(Inputs(spark, sf_dir).mvd)
    return ts.count_by_time_filled(late, "actual_timestamp", "delay_count", "1 hour")


@query
def canx_hourly_filled(spark, sf_dir):
    """B-01, cancellations."""
    return ts.count_by_time_filled(Inputs(spark, sf_dir).cxd, "canx_timestamp", "cancel_count", "1 hour")


def _delays_over_time(duration):
    def run(spark, sf_dir):
        late = stats.late_movements(Inputs(spark, sf_dir).mvd)
        return ts.count_by_time(late, "actual_timestamp", "delay_count", duration)
    return run


@query
def delays_over_time_10min(spark, sf_dir):
    """B-02, 10 minutes."""
    return _delays_over_time("10 minutes")(spark, sf_dir)


@query
def delays_over_time_1h(spark, sf_dir):
    """B-02, 1 hour."""
    return _delays_over_time("1 hour")(spark, sf_dir)


@query
def delays_over_time_1d(spark, sf_dir):
    """B-02, 1 day."""
    return _delays_over_time("1 day")(spark, sf_dir)


@query
def canx_over_time_1h(spark, sf_dir):
    """B-02, cancellations."""
    return ts.count_by_time(Inputs(spark, sf_dir).cxd, "canx_timestamp", "cancel_count", "1 hour")


@query
def abnormal_over_time_1h(spark, sf_dir):
    """B-02, anomalies."""
    return ts.count_by_time(Inputs(spark, sf_dir).ab, "event_timestamp", "abnormal_count", "1 hour")


# --- time series from the cascade (one scan of the facts for all rates) -------

@query
def rollup_partials(spark, sf_dir):
    """A-20/B-02: 10-minute partials of both facts."""
    i = Inputs(spark, sf_dir)
    return rollup.bucket_partials(i.mvd_raw, i.cxd_raw).withColumn("delay_us", F.col("delay_us").cast("long"))


@query
def rollup_station_window_stats(spark, sf_dir):
    """A-20 from the partials."""
    return _r4(rollup.window_stats(Inputs(spark, sf_dir).partials), "avg_delay")


@query
def rollup_delays_over_time_1h(spark, sf_dir):
    """B-02 from the partials, 1 hour."""
    return rollup.count_over_time(Inputs(spark, sf_dir).partials, "late", "1 hour", "actual_timestamp", "delay_count")


@query
def rollup_delays_over_time_1d(spark, sf_dir):
    """B-02 from the partials, 1 day."""
    return rollup.count_over_time(Inputs(spark, sf_dir).partials, "late", "1 day", "actual_timestamp", "delay_count")


@query
def rollup_canx_hourly_filled(spark, sf_dir):
    """B-01 from the partials; its span too."""
    return rollup.count_over_time_filled(
        Inputs(spark, sf_dir).partials, "cancellations", "1 hour", "canx_timestamp", "cancel_count")


@query
def rollup_spike_counts_daily(spark, sf_dir):
    """B-03 from the partials, one-day buckets."""
    return rollup.spike_counts(Inputs(spark, sf_dir).partials, duration="1 day")


# --- station map ------------------------------------------------------------

def _flat_map(rows: DataFrame) -> DataFrame:
    out = rows
    for i, ch in enumerate("rgba"):
        out = out.withColumn(f"delay_color_{ch}", F.col("delay_color")[i])
        out = out.withColumn(f"abnormal_color_{ch}", F.col("abnormal_color")[i])
    out = out.drop("delay_color", "abnormal_color")
    return _r4(out, "avg_delay", "marker_size", "abnormal_marker_size")


def _station_map(i: Inputs) -> DataFrame:
    return smap.station_map(i.station_mvd, i.coords, i.ab, station_bound=i.dim_rows, coords_rows=i.coords_rows)


@query
def station_stats(spark, sf_dir):
    """A-15."""
    return _r4(smap.station_stats(Inputs(spark, sf_dir).station_mvd), "avg_delay")


@query
def station_abnormal_counts(spark, sf_dir):
    """A-16."""
    return smap.station_abnormal_counts(Inputs(spark, sf_dir).ab)


@query
def station_map(spark, sf_dir):
    """C-04 (colours as scalar channels)."""
    return _flat_map(_station_map(Inputs(spark, sf_dir)))


@query
def abnormal_map(spark, sf_dir):
    """F-10 (default minimum of 3 anomalies)."""
    return _flat_map(smap.abnormal_map(_station_map(Inputs(spark, sf_dir))))


@query
def abnormal_map_above_mean(spark, sf_dir):
    """F-10 with a minimum that drops stations: the mean number of anomalies, rounded up."""
    rows = _station_map(Inputs(spark, sf_dir))
    least = rows.agg(F.ceil(F.avg("abnormal_count"))).first()[0]
    return _flat_map(smap.abnormal_map(rows, least or 0))
