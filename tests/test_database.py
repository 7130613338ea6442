"""Transactions, ledger, definitions and split reads on the embedded in-memory database."""

import threading

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from signalbox.schemas import ANOMALY_SCHEMA, MOVEMENT_TABLE_SCHEMA
from signalbox.sinks.database import Database, JdbcBatchSink
from signalbox.sources.tables import key_predicates, read_table
from tests.conftest import rows
from tests.helpers import T0, cancellation_table, movement_table

PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _url(name):
    return f"jdbc:derby:memory:{name};create=true"


def _mv(train, delay=60.0):
    return (train, "00001", "TPL", "AAA", "N", "ARRIVAL", T0, T0 + 60_000, "LATE", delay)


def _cx(train, at=T0):
    return (train, "S", "1", "00001", "TPL", "AAA", "N", at, "R", "X")


def _ab(spark, n, score=1.0):
    return spark.range(n).select(
        *[F.lit(score if f.name == "anomaly_score" else None).cast(f.dataType).alias(f.name)
          for f in ANOMALY_SCHEMA.fields[:-1]], F.col("id").cast("string").alias("explanation"))


def _value(db, sql):
    with db.connection() as c:
        found = c.createStatement().executeQuery(sql)
        found.next()
        return found.getLong(1)


def test_replacement_is_never_seen_empty(spark):
    db = Database(spark, _url("replace"), PROPS)
    assert db.replace_table(_ab(spark, 400), "abnormal_events") == 400
    counts, stop = [], threading.Event()

    def watch():
        while not stop.is_set():
            counts.append(_value(db, "SELECT COUNT(*) FROM abnormal_events"))

    reader = threading.Thread(target=watch)
    reader.start()
    try:
        for n in (500, 300, 700):
            assert db.replace_table(_ab(spark, n), "abnormal_events") == n
    finally:
        stop.set()
        reader.join()
    assert counts and set(counts) <= {400, 500, 300, 700}
    # Keys and insert times are the database's.
    with db.connection() as c:
        found = c.createStatement().executeQuery(
            'SELECT COUNT(DISTINCT "id"), COUNT("detected_at"), COUNT(*) FROM abnormal_events')
        found.next()
        assert [found.getLong(i) for i in (1, 2, 3)] == [700, 700, 700]
    assert db.replace_table(_ab(spark, 0), "abnormal_events") == 0
    assert _value(db, "SELECT COUNT(*) FROM abnormal_events") == 0


def test_a_failed_replacement_leaves_the_old_rows(spark):
    db = Database(spark, _url("fails"), PROPS)
    db.replace_table(_ab(spark, 5), "abnormal_events")
    db.transaction(["ALTER TABLE abnormal_events ADD CONSTRAINT known CHECK (\"anomaly_score\" < 9)"])
    with pytest.raises(Py4JJavaError):
        db.replace_table(_ab(spark, 7, 99.0), "abnormal_events")  # fails between delete and commit
    assert _value(db, "SELECT COUNT(*) FROM abnormal_events") == 5
    assert db.replace_table(_ab(spark, 6), "abnormal_events") == 6  # what was staged is no hindrance


def test_batches_are_replayed_without_a_trace_and_read_singly(spark):
    sink = JdbcBatchSink(spark, _url("ledger"), PROPS)
    assert sink.last_batch(spark) == -1 and sink.read_movements(spark).count() == 0
    sink.write(movement_table(spark, [_mv("A"), _mv("A"), _mv("B")]), cancellation_table(spark, [_cx("A")]), 0)
    sink.write(movement_table(spark, [_mv("C")]), cancellation_table(spark, []), 1)
    contents = [rows(t.drop("inserted_at")) for t in (
        sink.read_movements_with_batch(spark), sink.read_cancellations_with_batch(spark))]
    assert len(contents[0]) == 3 and len(contents[1]) == 1
    for _ in range(2):
        sink.write(movement_table(spark, [_mv("C")]), cancellation_table(spark, []), 1)
    assert contents == [rows(t.drop("inserted_at")) for t in (
        sink.read_movements_with_batch(spark), sink.read_cancellations_with_batch(spark))]
    assert rows(sink.batches().drop("inserted_at")) == [(0, 2, 1), (1, 1, 0)] and sink.last_batch(spark) == 1
    again = JdbcBatchSink(spark, _url("ledger"), PROPS)  # a restart finds its tables
    one = again.read_movements_with_batch(spark).filter("batch_id = 1")
    assert rows(one.select("train_id", "event_date")) == [("C", __import__("datetime").date(2024, 1, 1))]
    # A batch whose second table fails changes neither table nor ledger.
    sink.db.transaction(["ALTER TABLE raw_train_cancellations ADD CONSTRAINT known CHECK (\"canx_timestamp\" > 0)"])
    with pytest.raises(Py4JJavaError):
        sink.write(movement_table(spark, [_mv("D")]), cancellation_table(spark, [_cx("Z", -1)]), 2)
    assert sink.read_movements(spark).count() == 3 and sink.last_batch(spark) == 1


def test_steps_accept_the_sink(spark, tmp_dir):
    from signalbox.plans.detection import detect_from_tables
    from signalbox.streaming.clean import IncrementalClean
    from signalbox.streaming.detection import IncrementalDetection, read_incremental_anomalies

    sink = JdbcBatchSink(spark, _url("steps"), PROPS)
    clean = IncrementalClean(spark, sink, f"{tmp_dir}/clean")
    clean.then = IncrementalDetection(spark, sink, f"{tmp_dir}/ab", clean=clean)
    data = [_mv(f"t{i}", 60.0 + i % 2) for i in range(30)]
    for batch, part in enumerate((data[:20], data[15:] + [_mv("late", 7200.0)])):
        sink.write(movement_table(spark, part), cancellation_table(spark, []), batch)
        clean(batch)
    found = rows(read_incremental_anomalies(spark, f"{tmp_dir}/ab"))
    assert found == rows(detect_from_tables(spark, sink)) and len(found) == 2


def test_reads_are_split_by_rows(spark):
    """A skewed key with nulls: no empty range, no row twice, about equal shares where values allow."""
    url = _url("split")
    keys = [5] * 300 + list(range(1000, 1400)) + [10**9 + i for i in range(300)] + [None] * 40
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, v long")
    df.write.format("jdbc").options(url=url, dbtable="facts", **PROPS).mode("overwrite").save()
    ranges = key_predicates(spark, url, "facts", "k", 8, PROPS)
    db = Database(spark, url, PROPS)
    sizes = [_value(db, f"SELECT COUNT(*) FROM facts WHERE {r}") for r in ranges]
    assert sum(sizes) == len(keys) and min(sizes) > 0 and len(ranges) == len(set(ranges)) <= 9
    assert max(s for s, r in zip(sizes, ranges, strict=True) if "NULL" not in r) <= 300 + 130
    read = read_table(spark, "facts", jdbc_url=url, properties=PROPS, partition_column="k", num_partitions=8)
    assert read.rdd.getNumPartitions() == len(ranges)
    assert rows(read) == rows(df)
    for table, made in (("t_one", "SELECT 7 AS k"), ("t_none", "SELECT 7 AS k WHERE false"), ("t_nulls", "SELECT CAST(NULL AS INT) AS k")):
        spark.sql(made).write.format("jdbc").options(url=url, dbtable=table, **PROPS).mode("overwrite").save()
        got = read_table(spark, table, jdbc_url=url, properties=PROPS, partition_column="k", num_partitions=4)
        assert got.count() == (0 if table == "t_none" else 1) and got.rdd.getNumPartitions() == 1


def test_a_missing_table_is_an_empty_frame(spark, tmp_dir):
    for where in ({"base_path": tmp_dir}, {"jdbc_url": _url("missing"), "properties": PROPS}):
        got = read_table(spark, "nowhere", schema=MOVEMENT_TABLE_SCHEMA, **where)
        assert got.count() == 0 and got.schema == MOVEMENT_TABLE_SCHEMA
    movement_table(spark, [_mv("A")]).write.parquet(f"{tmp_dir}/there")
    assert read_table(spark, "there", base_path=tmp_dir, schema=MOVEMENT_TABLE_SCHEMA).count() == 1
