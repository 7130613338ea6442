import datetime as dt

from pyspark.sql import functions as F

from signalbox.functions.columns import epoch_ms_to_ts
from signalbox.operators import timeseries as ts
from tests.conftest import rows
from tests.helpers import HOUR_MS, T0, cancellation_table, movement_table


def _times(spark, ms_list):
    return spark.createDataFrame([(m,) for m in ms_list], "ms long").select(epoch_ms_to_ts("ms").alias("t"))


def test_filled_hours_include_empty_buckets(spark):
    df = _times(spark, [T0, T0 + 1, T0 + 3 * HOUR_MS - 1, T0 + 3 * HOUR_MS, None])
    got = rows(ts.count_by_time_filled(df, "t", "n", "1 hour"), order=None)
    assert [(str(a), b) for a, b in got] == [
        ("2024-01-01 00:00:00", 2), ("2024-01-01 01:00:00", 0), ("2024-01-01 02:00:00", 1), ("2024-01-01 03:00:00", 1)]
    assert sum(b for _, b in got) == 4  # bucket sum = non-null input rows
    assert ts.count_by_time(df, "t", "n", "1 hour").count() == 3


def test_empty_input(spark):
    df = _times(spark, [])
    assert ts.count_by_time_filled(df, "t", "n", "1 hour").count() == 0
    assert ts.count_by_time(df, "t", "n", "1 day").count() == 0


def test_day_and_ten_minute_buckets_align_to_midnight(spark):
    df = _times(spark, [T0 + 23 * HOUR_MS + 59 * 60_000, T0 + 24 * HOUR_MS, T0 + 9 * 60_000, T0 + 10 * 60_000])
    days = rows(ts.count_by_time(df, "t", "n", "1 day"))
    assert [(str(a), b) for a, b in days] == [("2024-01-01 00:00:00", 3), ("2024-01-02 00:00:00", 1)]
    tens = {str(a): b for a, b in rows(ts.count_by_time(df, "t", "n", "10 minutes"))}
    assert tens["2024-01-01 00:00:00"] == 1 and tens["2024-01-01 00:10:00"] == 1


def test_station_window_stats(spark):
    mv = movement_table(spark, [
        ("T1", "1", "TP", "AAA", "S", "ARRIVAL", T0, T0 + 60_000, "LATE", 60.0),
        ("T2", "1", "TP", "AAA", "S", "ARRIVAL", T0, T0 + 5 * 60_000, "LATE", 180.0),
        ("T3", "1", "TP", "AAA", "S", "ARRIVAL", T0, T0 + 11 * 60_000, "LATE", 120.0),
    ])
    cx = cancellation_table(spark, [("T4", "S", "1", "1", "TP", "AAA", "S", T0 + 2 * 60_000, "R", "X")])
    out = ts.station_window_stats(ts.window_events(mv, cx))
    got = rows(out)
    assert got[0][:3] == (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 10), "S")
    assert got[0][3:] == (3, 2.0, 1)
    assert got[1][3:] == (1, 2.0, 0)
    per_station = rows(ts.window_station_delay(out))
    assert per_station == [("S", 2.0)]
    assert rows(ts.window_station_cancels(out)) == [("S", 1)]
    assert [r[1] for r in rows(ts.window_event_totals(out))] == [3, 1]
    assert dict(out.dtypes)["window_start"] == "timestamp_ntz"


def test_filled_spine_spans_many_chunks(spark):
    # 2,000 hourly buckets with only the ends filled: the spine crosses chunks
    df = _times(spark, [T0, T0 + 1999 * HOUR_MS])
    out = ts.count_by_time_filled(df, "t", "n", "1 hour", chunk=64)
    got = rows(out)
    assert len(got) == 2000 and sum(n for _, n in got) == 2
    assert str(got[0][0]) == "2024-01-01 00:00:00" and got[-1][1] == 1
    assert len({t for t, _ in got}) == 2000
