from signalbox.sinks import writers as w
from signalbox.schemas import ANOMALY_SCHEMA, WINDOW_RESULT_SCHEMA
from tests.conftest import rows
from tests.helpers import movement_table


def _mv_row(train, status="LATE"):
    return (train, "00001", "TPL", "AAA", "N", "ARRIVAL", 0, 60_000, status, 60.0)


def test_batch_partition_replay_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    w.write_batch_partition(movement_table(spark, [_mv_row("A"), _mv_row("B")]), path, 0)
    w.write_batch_partition(movement_table(spark, [_mv_row("C")]), path, 1)
    w.write_batch_partition(movement_table(spark, [_mv_row("C")]), path, 1)  # replayed batch
    out = spark.read.parquet(path)
    assert rows(out.select("train_id", "batch_id")) == [("A", 0), ("B", 0), ("C", 1)]
    assert dict(out.dtypes)["inserted_at"] == "timestamp_ntz"


def test_fact_sink_dedups_within_batch(spark, tmp_dir):
    sink = w.ParquetFactSink(tmp_dir)
    mv = movement_table(spark, [_mv_row("A"), _mv_row("A"), _mv_row("A", "late")])
    cx = spark.createDataFrame([], "train_id string, train_service_code string, toc_id string, loc_stanox string, "
                                   "tiploc string, alpha3 string, local_name string, canx_timestamp long, "
                                   "canx_reason_code string, canx_type string")
    sink.write(mv, cx, 0)
    assert sink.read_movements(spark).count() == 1  # write-time key ignores the status
    assert sink.read_cancellations(spark).count() == 0


def test_snapshot_replace(spark, tmp_dir):
    path = f"{tmp_dir}/abnormal"
    assert w.read_snapshot(spark, path).count() == 0
    one = spark.createDataFrame([("movement", "T", None, None, "N", "X", None, 1.0, "large_delay", 1.0, "e")], ANOMALY_SCHEMA)
    w.replace_snapshot(one, path)
    w.replace_snapshot(one.union(one), path)
    assert w.read_snapshot(spark, path).count() == 2
    w.replace_snapshot(one.limit(0), path)  # nothing found: the table becomes empty
    assert w.read_snapshot(spark, path).count() == 0
    import os

    os.makedirs(f"{path}/v=000000000000001")  # failed write: no _SUCCESS, older than current
    removed = w.prune_snapshots(spark, path, keep=2)
    assert len(removed) == 2 and w.read_snapshot(spark, path).count() == 0
    assert len(w._finished_snapshots(spark, path)) == 2
    assert not os.path.exists(f"{path}/v=000000000000001")


def test_window_updates_latest_batch_wins(spark, tmp_dir):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    first = spark.createDataFrame([(t, t, "S", 1, 2.0, 0), (t, t, "R", 1, 1.0, 1)], WINDOW_RESULT_SCHEMA)
    second = spark.createDataFrame([(t, t, "S", 3, 4.0, 1)], WINDOW_RESULT_SCHEMA)
    path = f"{tmp_dir}/w"
    w.write_window_updates(first, path, 0)
    w.write_window_updates(second, path, 1)
    got = rows(w.read_window_stats(spark, path).select("station", "event_count", "avg_delay"))
    assert got == [("R", 1, 1.0), ("S", 3, 4.0)]


def test_jdbc_derby_append_and_overwrite(spark):
    url = "jdbc:derby:memory:signalbox_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = movement_table(spark, [_mv_row("A")])
    sink = w.JdbcFactSink(url, props)
    cx = spark.createDataFrame([("T", "S", "1", "1", "TPL", "A", "N", 5, "R", "X")],
                               "train_id string, train_service_code string, toc_id string, loc_stanox string, "
                               "tiploc string, alpha3 string, local_name string, canx_timestamp long, "
                               "canx_reason_code string, canx_type string")
    sink.write(df, cx, 0)
    sink.write(df, cx, 1)  # at-least-once: the second append duplicates
    assert sink.read_movements(spark).count() == 2
    ab = spark.createDataFrame([("movement", "T", None, None, "N", "X", None, 1.0, "large_delay", 1.0, "e")], ANOMALY_SCHEMA)
    w.replace_jdbc_table(ab.union(ab), url, "abnormal_events", props)
    w.replace_jdbc_table(ab, url, "abnormal_events", props)
    assert w.read_jdbc(spark, url, "abnormal_events", props).count() == 1
    assert [r.train_id for r in w.read_jdbc(spark, url, "raw_train_movements", props).collect()] == ["A", "A"]


def test_partitioned_jdbc_and_parquet_table_reads(spark, tmp_dir):
    from signalbox.sources.tables import read_table

    url = "jdbc:derby:memory:signalbox_read;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(100).selectExpr("id", "cast(id % 7 as string) as k")
    w.write_jdbc(df, url, "facts", "overwrite", props)
    parts = read_table(spark, "facts", jdbc_url=url, properties=props, partition_column="id",
                       bounds=(0, 100), num_partitions=4)
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 100
    df.write.parquet(f"{tmp_dir}/facts")
    assert read_table(spark, "facts", base_path=tmp_dir).count() == 100
