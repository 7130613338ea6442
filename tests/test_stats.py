from pyspark.sql import functions as F

from signalbox.operators import stats
from tests.conftest import rows


def test_smoke_average_by_station(spark):
    df = spark.createDataFrame([("London Euston", 5), ("London Euston", 12), ("Manchester Piccadilly", 3)],
                               ["station", "delay_minutes"])
    assert rows(stats.avg_by_key(df, "station", "delay_minutes")) == [
        ("London Euston", 8.5), ("Manchester Piccadilly", 3.0)]


def _delays(spark):
    return spark.createDataFrame(
        [("A", "LATE", 100.0), ("A", "LATE", 300.0), ("B", "LATE", 200.0), ("B", "EARLY", -50.0),
         (None, "LATE", 900.0), ("C", "late", 50.0), ("C", None, 10.0)],
        "local_name string, variation_status string, delay_seconds double")


def test_late_statistics_exact_status(spark):
    df = _delays(spark)
    assert rows(stats.late_by_location(df), order=True) == [("A", 2), (None, 1), ("B", 1)]
    got = rows(stats.late_delay_by_location(df), order=True)
    assert got == [(None, 1, 900.0), ("A", 2, 200.0), ("B", 1, 200.0)]


def test_value_counts_unknown_and_ties(spark):
    df = _delays(spark)
    assert rows(stats.status_distribution(df), order=True) == [
        ("LATE", 4), ("EARLY", 1), ("late", 1), ("unknown", 1)]
    top = stats.top_delayed(df.withColumn("delay_minutes", F.col("delay_seconds") / 60), n=2)
    # case-insensitive late: A=2, B=1, C=1, unknown=1 -> ties broken by name
    assert rows(top, order=True) == [("A", 2), ("B", 1)]


def test_top_avg_delay_drops_null_station(spark):
    df = _delays(spark).withColumn("delay_minutes", F.col("delay_seconds") / 60)
    out = rows(stats.top_avg_delay(df, n=10), order=True)
    assert [r[0] for r in out] == ["A", "B", "C"]


def test_anomaly_labels(spark):
    df = spark.createDataFrame([("large_delay",), ("large_delay",), ("cancellation_spike",), ("other",), (None,)],
                               "anomaly_type string")
    assert rows(stats.anomaly_type_distribution(df), order=True) == [
        ("Large Delay", 2), ("Cancellation Spike", 1), ("other", 1), ("unknown", 1)]


def test_dashboard_kpis(spark):
    mv = spark.createDataFrame([("AAA", "LATE", 10.0), ("", "LATE", 20.0), (None, "EARLY", 5.0), ("BBB", "late", None)],
                               "alpha3 string, variation_status string, delay_minutes double")
    cx = spark.createDataFrame([("x",), ("y",)], "alpha3 string")
    ab = spark.createDataFrame([("AAA",), ("",), (None,)], "alpha3 string")
    k = stats.dashboard_kpis(mv, cx, ab).first()
    assert (k.movement_events, k.station_delayed_events, k.cancellation_events, k.station_abnormal_events) == (4, 2, 2, 1)
    assert k.avg_station_delay == 10.0
