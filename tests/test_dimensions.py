import json
import os

from signalbox.operators import transforms as tf
from signalbox.sources import dimensions as dims
from tests.conftest import rows
from tests.helpers import feed_df, movement


def _records(spark, recs):
    return spark.createDataFrame(recs, "STANOX string, TIPLOC string, `3ALPHA` string, NLCDESC string, NLCDESC16 string")


def test_location_dim_edge_rows(spark):
    recs = [
        (" 00001 ", " TPLB ", "", " Name B ", "B"),          # padded, no station code
        ("00001", "TPLZ", "ABC", "Name Z", "Z"),               # same key with station code: wins
        ("", "X", "XXX", "blank", "b"), ("   ", "Y", "YYY", "spaces", "s"), (None, "N", "NNN", "null", "n"),
        ("00002", "TPLC", "CCC", "C1", "c"), ("00002", "TPLA", "AAA", "A1", "a"),  # both with codes: smallest tiploc
        ("00003", "TPL3", None, "Three", "3"),
    ]
    dim = dims.location_dim(_records(spark, recs))
    assert rows(dim) == [
        ("00001", "TPLZ", "ABC", "Name Z", "Z"),
        ("00002", "TPLA", "AAA", "A1", "a"),
        ("00003", "TPL3", None, "Three", "3"),
    ]


def test_location_dim_is_order_independent(spark):
    recs = [("00001", f"T{i}", "" if i % 3 else f"A{i}", f"N{i}", "n") for i in range(30)]
    a = rows(dims.location_dim(_records(spark, recs)))
    b = rows(dims.location_dim(_records(spark, list(reversed(recs))).repartition(7)))
    assert a == b == [("00001", "T0", "A0", "N0", "n")]


def test_read_corpus_file(spark, tmp_dir):
    doc = {"TIPLOCDATA": [{"STANOX": " 123 ", "TIPLOC": "T", "3ALPHA": "ABC", "NLCDESC": "Name", "NLCDESC16": "N"}]}
    path = os.path.join(tmp_dir, "corpus.json")
    with open(path, "w") as f:
        json.dump(doc, f, indent=2)
    assert rows(dims.load_corpus(spark, path)) == [("123", "T", "ABC", "Name", "N")]


def test_join_keeps_every_left_row(spark):
    dim = dims.location_dim(_records(spark, [("00001", "T1", "AAA", "One", "1")]))
    mv = tf.calculate_delay(tf.extract_movements(feed_df(spark, [
        movement(train="a", stanox="00001"), movement(train="b", stanox="00009"), movement(train="c", stanox=None)])))
    out = tf.add_location_names(mv, dim)
    assert out.count() == 3
    assert rows(out.select("train_id", "local_name")) == [("a", "One"), ("b", None), ("c", None)]
    assert {"loc_stanox", "stanox", "tiploc", "alpha3", "local_name", "local_name_short"} <= set(out.columns)


def test_station_coordinates(spark, tmp_dir):
    recs = [
        {"3alpha": "AAA", "station_name": "A", "latitude": "51.5", "longitude": "-0.1"},
        {"3alpha": "AAA", "station_name": "A2", "latitude": "1", "longitude": "1"},  # later duplicate
        {"3alpha": "BBB", "station_name": None, "latitude": "n/a", "longitude": "1"},  # bad number -> dropped
        {"3alpha": "BBB", "station_name": "B", "latitude": 52, "longitude": 1},
        {"3alpha": None, "station_name": "C", "latitude": "1", "longitude": "1"},
    ]
    path = os.path.join(tmp_dir, "coords.json")
    with open(path, "w") as f:
        json.dump(recs, f, indent=2)
    out = dims.load_station_coordinates(spark, path)
    assert rows(out) == [("AAA", "A", 51.5, -0.1), ("BBB", "B", 52.0, 1.0)]
    missing = dims.load_station_coordinates(spark, os.path.join(tmp_dir, "nope.json"))
    assert missing.count() == 0 and missing.columns == ["alpha3", "station_name", "latitude", "longitude"]
