from signalbox.plans import batch_analysis, detection, report
from signalbox.plans.inputs import Inputs
from signalbox.sinks.writers import read_snapshot
from tests.conftest import SF_SMALL


def test_detection_job_publishes_snapshot(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    path = f"{tmp_dir}/abnormal_events"
    detection.run_detection(spark, i.landed.sink, path, station_bound=i.dim_rows)
    published = read_snapshot(spark, path)
    assert published.count() == i.ab.count() > 0


def test_report_job(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    sink = i.landed.sink
    anomalies = detection.detect_from_tables(spark, sink, i.dim_rows)
    frames = report.build_report(sink.read_movements(spark), sink.read_cancellations(spark), anomalies,
                                 i.coords, bucket="1D", station_bound=i.dim_rows)
    kpis = frames["kpis"].first()
    assert kpis.movement_events == i.mvd.count()
    assert kpis.cancellation_events == i.cxd.count()
    assert frames["station_map"].count() > 0
    assert frames["preview_station_movements"].count() <= 100
    report.write_report({k: frames[k] for k in ("kpis", "station_map")}, f"{tmp_dir}/report")
    assert spark.read.parquet(f"{tmp_dir}/report/kpis").count() == 1
    charts = report.chart_report(sink.read_movements(spark), sink.read_cancellations(spark))
    assert charts["delay_over_time"].count() >= charts["top_delayed_stations"].count()


def test_batch_analysis(spark):
    i = Inputs(spark, SF_SMALL)
    out = batch_analysis.run_batch_analysis(i.feed, i.dim)
    assert out["late_delay_by_location"].count() > 0
    assert sum(r["count"] for r in out["movements_by_status"].collect()) == i.mv.count()


def test_cluster_conf_scales_partitions():
    from signalbox.session import cluster_conf

    conf = cluster_conf(8000)
    assert conf["spark.sql.shuffle.partitions"] == "24000"
    assert conf["spark.sql.session.timeZone"] == "UTC"
    assert cluster_conf(4)["spark.sql.shuffle.partitions"] == "200"
