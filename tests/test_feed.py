import json
import os

from pyspark.sql import functions as F

from signalbox.operators import stats, transforms as tf
from signalbox.sources import feed as fs
from tests.conftest import rows
from tests.helpers import feed_df, message, movement


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_read_feed_array_object_and_stray_files(spark, tmp_dir):
    one = {"header": {"msg_type": "0003"}, "body": {"train_id": "A", "loc_stanox": "1"}}
    two = [{"header": {"msg_type": "0002"}, "body": {"train_id": "B", "canx_timestamp": "5"}},
           {"header": {"msg_type": "0003"}, "body": {"train_id": "C"}}]
    _write(tmp_dir, "m1.json", json.dumps(one, indent=2))
    _write(tmp_dir, "m2.json", json.dumps(two, indent=2))
    _write(tmp_dir, "m3_raw.txt", "not json at all")
    feed = fs.read_feed(spark, tmp_dir)
    assert rows(feed.select("header.msg_type", "body.train_id")) == [("0002", "B"), ("0003", "A"), ("0003", "C")]


def test_parse_text_handles_arrays_objects_and_corrupt(spark):
    texts = [
        ('{"header":{"msg_type":"0003"},"body":{"train_id":"A"}}',),
        ('[{"header":{"msg_type":"0002"},"body":{"train_id":"B"}},{"header":{"msg_type":"0003"},"body":{"train_id":"C"}}]',),
        ('{"header":{"msg_type":"0003"}',),
        ("<html>",),
        ('{"body":{"train_id":"D"}}',),
    ]
    df = spark.createDataFrame(texts, "value string")
    parsed = fs.classify_feed_text(df)
    got = rows(parsed.select("status", "header.msg_type", "body.train_id"))
    assert ("ok", "0003", "A") in got and ("ok", "0002", "B") in got and ("ok", "0003", "C") in got
    assert ("ok", None, "D") in got  # null header is parsed, then ignored by the extractors
    assert sum(1 for g in got if g[0] == "corrupt") == 2
    assert rows(fs.quarantine_counts(df)) == [("corrupt", 2), ("ok", 4)]
    good, bad = fs.quarantine_split(df)
    assert good.count() == 4 and bad.count() == 2


def test_extract_ignores_unknown_and_null_types(spark):
    feed = feed_df(spark, [message("0003", train_id="A"), message("0002", train_id="B"),
                           message("0001", train_id="C"), message(None, train_id="D"),
                           (None, None)])
    assert rows(tf.extract_movements(feed).select("train_id")) == [("A",)]
    assert rows(tf.extract_cancellations(feed).select("train_id")) == [("B",)]
    assert rows(stats.count_by_msg_type(feed)) == [("0001", 1), ("0002", 1), ("0003", 1), (None, 2)]


def test_bad_times_become_null_not_errors(spark):
    msgs = [movement(train=t, planned=p, actual=a) for t, p, a in [
        ("e1", "", "1000"), ("e2", "x", "1000"), ("e3", " 5 ", "1005"), ("e4", "1.5", "1000"), ("e5", None, "1000"),
    ]]
    out = tf.calculate_delay(tf.extract_movements(feed_df(spark, msgs)))
    got = {r.train_id: (r.planned_timestamp, r.delay_seconds) for r in out.collect()}
    assert got["e1"] == (None, None) and got["e2"] == (None, None) and got["e5"] == (None, None)
    assert got["e3"] == (5, 1.0)  # surrounding spaces are accepted
    assert got["e4"] == (None, None)  # fractional text is not a valid long
    cx = feed_df(spark, [message("0002", train_id="c", canx_timestamp="abc")])
    assert tf.extract_cancellations(cx).first().canx_timestamp is None


def test_delay_signs_and_threshold(spark):
    msgs = [movement(train="early", planned=10_000, actual=4_000),
            movement(train="zero", planned=10_000, actual=10_000),
            movement(train="limit", planned=0, actual=1_800_000)]
    out = {r.train_id: r.delay_seconds for r in tf.calculate_delay(tf.extract_movements(feed_df(spark, msgs))).collect()}
    assert out == {"early": -6.0, "zero": 0.0, "limit": 1800.0}


def test_header_preview_and_flatten(spark):
    feed = feed_df(spark, [message("0003", train_id="A")])
    assert tf.header_preview(feed).columns == ["msg_type", "queue_timestamp", "source_system_id"]
    flat = tf.flatten_feed(feed)
    assert len(flat.columns) == 15 and flat.first().train_id == "A"
    assert flat.filter(F.col("msg_type") == "0003").count() == 1


def test_compact_feed_round_trip(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(src, "a.json", json.dumps([{"header": {"msg_type": "0003"}, "body": {"train_id": "A"}},
                                      {"header": {"msg_type": "0002"}, "body": {"train_id": "B"}}], indent=2))
    _write(src, "b.json", json.dumps({"body": {"train_id": "C"}}, indent=2))
    out = os.path.join(tmp_dir, "compact")
    fs.compact_feed(spark, src, out)
    everything = fs.read_compacted_feed(spark, out)
    assert rows(everything.select("body.train_id")) == [("A",), ("B",), ("C",)]
    movements = tf.extract_movements(fs.read_compacted_feed(spark, out, ["0003"]))
    assert rows(movements.select("train_id")) == [("A",)]
    plan = movements._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(msg_kind" in plan
