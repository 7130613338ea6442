import math

from signalbox.operators import station_map as smap
from signalbox.schemas import ANOMALY_SCHEMA, COORDINATE_SCHEMA
from tests.conftest import rows


def _mv(spark, data):
    return spark.createDataFrame(data, "alpha3 string, delay_minutes double")


def _coords(spark, data):
    return spark.createDataFrame(data, COORDINATE_SCHEMA)


def _ab(spark, alpha3s):
    recs = [("movement", "T", a, "1", "N", "ARRIVAL", None, 1.0, "large_delay", 1.0, "x") for a in alpha3s]
    return spark.createDataFrame(recs, ANOMALY_SCHEMA)


def test_station_map_rows(spark):
    mv = _mv(spark, [("AAA", 90.0)] * 2 + [("AAA", None)] + [("BBB", -5.0)] * 150 + [("CCC", 10.0), ("DDD", None)])
    coords = _coords(spark, [("AAA", "Alpha", 51.0, -1.0), ("BBB", None, 52.0, -2.0), ("DDD", "Delta", 53.0, -3.0)])
    ab = _ab(spark, ["AAA"] * 25 + ["", None])
    out = {r.alpha3: r for r in smap.station_map(mv, coords, ab).collect()}
    assert set(out) == {"AAA", "BBB", "DDD"}  # CCC has no coordinates
    a, b, d = out["AAA"], out["BBB"], out["DDD"]
    assert (a.event_count, a.avg_delay, a.large_delay_count, a.abnormal_count) == (3, 90.0, 2, 25)
    assert a.delay_color == [255, 40, 80, 80] and a.abnormal_color == [255, 220, 0, 230]
    assert math.isclose(a.marker_size, math.sqrt(3) * 1000) and math.isclose(a.abnormal_marker_size, math.sqrt(20) * 900)
    assert b.event_count == 150 and math.isclose(b.marker_size, 10_000.0)
    assert b.delay_color == [80, 180, 80, 80] and b.abnormal_count == 0 and b.abnormal_color == [0, 0, 0, 0]
    assert math.isclose(b.abnormal_marker_size, 900.0)
    assert d.avg_delay == 0.0  # no delays -> 0
    assert a.tooltip == "Alpha\nAlpha3: AAA\nEvents: 3\nAverage: 90.0 min\nLarge delays: 2\nAbnormal events: 25"
    assert b.tooltip.startswith("BBB\nAlpha3: BBB\n")  # missing name falls back to the code
    assert rows(smap.abnormal_map(smap.station_map(mv, coords, ab), 3).select("alpha3")) == [("AAA",)]


def test_color_midpoint_truncates(spark):
    mv = _mv(spark, [("AAA", 30.0), ("AAA", 31.0)])
    coords = _coords(spark, [("AAA", "A", 1.0, 1.0)])
    r = smap.station_map(mv, coords, _ab(spark, [])).first()
    assert r.delay_color == [80 + int(30.5 / 60 * 175), 180 - int(30.5 / 60 * 140), 80, 80]
    assert "Average: 30.5 min" in r.tooltip


def test_empty_movements_give_empty_frame_with_schema(spark):
    out = smap.station_map(_mv(spark, []), _coords(spark, [("AAA", "A", 1.0, 1.0)]), _ab(spark, ["AAA"]))
    assert out.count() == 0
    assert {"alpha3", "marker_size", "delay_color", "tooltip", "abnormal_count"} <= set(out.columns)


def test_abnormal_counts_skip_blank_codes(spark):
    assert rows(smap.station_abnormal_counts(_ab(spark, ["AAA", "AAA", "", None]))) == [("AAA", 2)]
