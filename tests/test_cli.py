import json
import os

from signalbox import cli
from signalbox.sinks.writers import ParquetFactSink

T0 = 1_704_067_200_000


def _msg(i, kind="0003", delay_ms=60_000):
    body = {"train_id": f"T{i}", "loc_stanox": "00001", "planned_timestamp": str(T0 + i * 1000),
            "actual_timestamp": str(T0 + i * 1000 + delay_ms), "variation_status": "LATE",
            "event_type": "ARRIVAL", "timetable_variation": "1", "canx_timestamp": str(T0 + i),
            "canx_reason_code": "R", "canx_type": "AT ORIGIN"}
    return {"header": {"msg_type": kind}, "body": body}


def test_jobs_end_to_end(spark, tmp_dir):
    feed = os.path.join(tmp_dir, "feed")
    os.makedirs(feed)
    msgs = [_msg(i) for i in range(14)] + [_msg(99, delay_ms=9_000_000)] + [_msg(200 + i, "0002") for i in range(6)]
    for n in range(3):
        with open(os.path.join(feed, f"m{n}.json"), "w") as f:
            json.dump(msgs[n * 7:(n + 1) * 7], f, indent=2)
    corpus = os.path.join(tmp_dir, "corpus.json")
    with open(corpus, "w") as f:
        json.dump({"TIPLOCDATA": [{"STANOX": "00001", "TIPLOC": "T", "3ALPHA": "AAA", "NLCDESC": "One",
                                   "NLCDESC16": "One"}]}, f)
    coords = os.path.join(tmp_dir, "coords.json")
    with open(coords, "w") as f:
        json.dump([{"3alpha": "AAA", "station_name": "One", "latitude": 51.0, "longitude": -1.0}], f)
    d = lambda name: os.path.join(tmp_dir, name)

    stats = cli.main(["batch", "--feed", feed, "--corpus", corpus, "--show", "3"], spark=spark)
    assert stats["late_delay_by_location"].count() == 1

    cli.main(["stream", "--feed", feed, "--corpus", corpus, "--tables", d("tables"), "--checkpoint", d("ckpt"),
              "--anomalies", d("inc"), "--clean", d("clean"), "--max-files", "1",
              "--available-now"], spark=spark)
    from signalbox.streaming.clean import read_clean_table

    assert read_clean_table(spark, d("clean") + "/movements", "movements").count() == 15
    sink = ParquetFactSink(d("tables"))
    assert sink.read_movements(spark).count() == 15 and sink.read_cancellations(spark).count() == 6

    cli.main(["detect", "--tables", d("tables"), "--anomalies", d("ab")], spark=spark)
    for flag in ([], ["--incremental"]):
        src = d("inc") if flag else d("ab")
        frames = cli.main(["report", "--tables", d("tables"), "--anomalies", src, *flag, "--coords", coords,
                           "--out", d("report" + "".join(flag))], spark=spark)
        k = frames["kpis"].first()
        assert (k.movement_events, k.cancellation_events, k.station_abnormal_events) == (15, 6, 2)
        assert spark.read.parquet(d("report" + "".join(flag)) + "/station_map").first().abnormal_count == 2
    charts = cli.main(["charts", "--tables", d("tables"), "--out", d("charts")], spark=spark)
    assert charts["top_cancelled_stations"].first()["count"] == 6

    cli.main(["window-stream", "--feed", feed, "--corpus", corpus, "--out", d("win"), "--checkpoint", d("wckpt"),
              "--watermark", "1 day", "--available-now"], spark=spark)
    from signalbox.sinks.writers import read_window_stats

    assert sum(r.event_count for r in read_window_stats(spark, d("win")).collect()) == 21
