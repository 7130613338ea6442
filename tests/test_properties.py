"""Property tests (hypothesis) for invariants the operators must keep."""

import math

from hypothesis import given, settings, strategies as st

from signalbox.functions.columns import epoch_ms_to_ts
from signalbox.operators import station_map as smap, timeseries as ts, transforms as tf
from signalbox.schemas import ANOMALY_SCHEMA, COORDINATE_SCHEMA
from signalbox.sources import dimensions as dims
from tests.helpers import HOUR_MS, T0, feed_df, movement

SETTINGS = settings(max_examples=6, deadline=None)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 200 * HOUR_MS)), min_size=1, max_size=40),
       st.sampled_from(["10 minutes", "1 hour", "1 day"]))
def test_filled_buckets_sum_to_input_and_have_no_gaps(spark, offsets, duration):
    df = spark.createDataFrame([(None if o is None else T0 + o,) for o in offsets], "ms long").select(
        epoch_ms_to_ts("ms").alias("t"))
    out = [(r.t, r.n) for r in ts.count_by_time_filled(df, "t", "n", duration, chunk=8).collect()]
    assert sum(n for _, n in out) == sum(o is not None for o in offsets)
    times = sorted(t for t, _ in out)
    if times:
        step = {"10 minutes": 600, "1 hour": 3600, "1 day": 86400}[duration]
        assert all((b - a).total_seconds() == step for a, b in zip(times, times[1:]))
        assert len(set(times)) == len(times)


@SETTINGS
@given(st.lists(st.sampled_from(["00001", "00002", "00009", None, ""]), min_size=1, max_size=30))
def test_location_join_keeps_left_row_count(spark, stanoxes):
    recs = [("00001", "T1", "AAA", "One", "1"), ("00001", "T0", "", "One0", "0"), ("00002", "T2", None, "Two", "2")]
    dim = dims.location_dim(spark.createDataFrame(
        recs, "STANOX string, TIPLOC string, `3ALPHA` string, NLCDESC string, NLCDESC16 string"))
    mv = tf.calculate_delay(tf.extract_movements(feed_df(spark, [movement(train=f"t{i}", stanox=s)
                                                                 for i, s in enumerate(stanoxes)])))
    assert tf.add_location_names(mv, dim).count() == len(stanoxes)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["AAA", "BBB"]),
                          st.one_of(st.none(), st.floats(-500, 500, allow_nan=False))), min_size=1, max_size=30),
       st.integers(0, 40))
def test_map_styling_stays_in_range(spark, moves, n_abnormal):
    mv = spark.createDataFrame(moves, "alpha3 string, delay_minutes double")
    coords = spark.createDataFrame([("AAA", "A", 1.0, 1.0), ("BBB", None, 2.0, 2.0)], COORDINATE_SCHEMA)
    ab = spark.createDataFrame(
        [("movement", "T", "AAA", "1", "N", "X", None, 1.0, "large_delay", 1.0, "e")] * n_abnormal, ANOMALY_SCHEMA)
    for r in smap.station_map(mv, coords, ab).collect():
        assert 1000.0 <= r.marker_size <= 10_000.0 + 1e-9
        assert 900.0 <= r.abnormal_marker_size <= math.sqrt(20) * 900 + 1e-9
        red, green, blue, alpha = r.delay_color
        assert 80 <= red <= 255 and 40 <= green <= 180 and (blue, alpha) == (80, 80)
        assert r.abnormal_color == ([255, 220, 0, 230] if r.abnormal_count else [0, 0, 0, 0])
        assert r.tooltip.count("\n") == 5
