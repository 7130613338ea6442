from signalbox.operators import anomaly
from tests.conftest import rows
from tests.helpers import HOUR_MS, T0, cancellation_table, movement_table


def _mv(name, delay, train="T", alpha3="AAA", stanox="00001", actual=T0):
    return (train, stanox, "TPL", alpha3, name, "ARRIVAL", actual, actual, "LATE", delay)


def test_large_delays_threshold_and_null_location(spark):
    df = movement_table(spark, [_mv("A", 1799.9), _mv("A", 1800.0), _mv(None, 4000.0, alpha3=None)])
    out = anomaly.detect_large_delays(df)
    assert rows(out.select("local_name", "anomaly_score")) == [("A", 1800.0), (None, 4000.0)]
    r = out.filter("local_name = 'A'").first()
    assert r.event_source == "movement" and r.anomaly_type == "large_delay"
    assert r.explanation == "Train delay is at least 30 minutes."
    assert str(r.event_timestamp) == "2024-01-01 00:00:00"


def test_outlier_gates(spark):
    data = [_mv("one", 100.0)]                                    # n = 1: no deviation
    data += [_mv("const", 60.0, train=f"c{i}") for i in range(12)]  # std = 0
    data += [_mv("ten", 0.0, train=f"t{i}") for i in range(9)] + [_mv("ten", 1000.0, train="t9")]  # n=10: z<3
    data += [_mv("eleven", 0.0, train=f"e{i}") for i in range(10)] + [_mv("eleven", 1000.0, train="e10")]
    data += [_mv(None, 99999.0, train="nowhere")]
    out = anomaly.detect_station_delay_outliers(movement_table(spark, data))
    got = rows(out.select("local_name", "train_id", "anomaly_score"))
    assert len(got) == 1 and got[0][:2] == ("eleven", "e10")
    assert abs(got[0][2] - 3.0151134) < 1e-6
    stats = {r.local_name: (r.n, r.std) for r in anomaly.station_delay_stats(movement_table(spark, data)).collect()}
    assert stats["one"] == (1, None) and stats["const"][1] == 0.0


def test_outliers_unchanged_by_positive_scaling(spark):
    base = [_mv("s", float(d), train=f"x{i}") for i, d in enumerate([1, 2, 2, 3, 2, 1, 2, 3, 2, 2, 2, 2, 90])]
    scaled = [r[:9] + (r[9] * 7.5,) for r in base]
    a = rows(anomaly.detect_station_delay_outliers(movement_table(spark, base)).select("train_id"))
    b = rows(anomaly.detect_station_delay_outliers(movement_table(spark, scaled)).select("train_id"))
    assert a == b == [("x12",)]


def _cx(name, ts, train="T"):
    return (train, "S", "1", "00001", "TPL", "AAA", name, ts, "R", "AT ORIGIN")


def test_cancellation_spikes(spark):
    data = [_cx("four", T0 + i) for i in range(4)]
    data += [_cx("five", T0 + HOUR_MS + i) for i in range(5)]
    data += [_cx("split", T0 + HOUR_MS - 2 - i) for i in range(3)] + [_cx("split", T0 + HOUR_MS + i) for i in range(2)]
    data += [_cx(None, T0 + i) for i in range(6)]
    df = cancellation_table(spark, data)
    out = anomaly.detect_cancellation_spikes(df)
    got = rows(out.select("local_name", "event_timestamp", "anomaly_score", "train_id", "alpha3", "event_type"))
    assert len(got) == 1
    assert got[0][0] == "five" and str(got[0][1]) == "2024-01-01 01:00:00" and got[0][2] == 5.0
    assert got[0][3] is None and got[0][4] is None and got[0][5] == "CANCELLATION_SPIKE"
    daily = rows(anomaly.detect_cancellation_spikes(df, window="1 day").select("local_name"))
    assert daily == [("five",), ("split",)]


def test_spikes_fall_back_to_location_code(spark):
    df = cancellation_table(spark, [_cx("n", T0 + i) for i in range(5)]).drop("local_name")
    out = anomaly.detect_cancellation_spikes(df)
    assert rows(out.select("local_name")) == [("00001",)]


def test_all_detectors_union(spark):
    mv = movement_table(spark, [_mv("eleven", 0.0, train=f"e{i}") for i in range(10)] + [_mv("eleven", 5000.0, train="big")])
    cx = cancellation_table(spark, [_cx("c", T0 + i) for i in range(5)])
    parts = [anomaly.detect_large_delays(mv).count(), anomaly.detect_station_delay_outliers(mv).count(),
             anomaly.detect_cancellation_spikes(cx).count()]
    out = anomaly.detect_anomalies(mv, cx)
    assert out.count() == sum(parts) == 3
    assert out.columns == ["event_source", "train_id", "alpha3", "loc_stanox", "local_name", "event_type",
                           "event_timestamp", "delay_seconds", "anomaly_type", "anomaly_score", "explanation"]
