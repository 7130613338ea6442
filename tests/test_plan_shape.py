"""Physical-plan properties the operators rely on at scale."""

from pyspark.sql import functions as F

from signalbox.operators import anomaly, dedup, stats, transforms as tf
from signalbox.operators.joins import join_small
from signalbox.plans.inputs import Inputs
from tests.conftest import SF_SMALL
from tests.helpers import T0, movement_table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_movements(spark, n=2000):
    # one station holds most rows, and one message is replayed many times
    data = [("T0", "00001", "TPL", "AAA", "Hot", "ARRIVAL", T0, T0 + 60_000, "LATE", 60.0)] * (n // 2)
    data += [(f"T{i}", "00001", "TPL", "AAA", "Hot", "ARRIVAL", T0, T0 + i * 1000, "LATE", float(i)) for i in range(n // 2)]
    data += [("X", "00002", "TPL", "BBB", "Cold", "ARRIVAL", T0, T0, "ON TIME", 0.0)]
    return movement_table(spark, data).repartition(4)


def test_dedup_combines_copies_before_the_shuffle(spark):
    plan = _plan(dedup.dedup_movements(_hot_movements(spark)))
    assert "partial_min" in plan and "Window" not in plan


def test_outliers_use_aggregate_and_broadcast_not_window(spark):
    df = anomaly.detect_station_delay_outliers(_hot_movements(spark), station_bound=10)
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "Window" not in plan
    assert "partial_avg" in plan and "partial_stddev_samp" in plan


def test_broadcast_only_within_bound(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _plan(join_small(big, small, "k", "inner", max_rows=10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(join_small(big, small, "k", "inner", max_rows=9))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_needs_byte_bound_too(spark):
    from signalbox.operators import joins

    big = spark.range(100).withColumnRenamed("id", "k")
    wide = spark.range(10).selectExpr("id as k", *[f"'x' as s{i}" for i in range(50)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        limit = joins.BROADCAST_MAX_BYTES
        joins.BROADCAST_MAX_BYTES = 10 * joins.row_width(wide) - 1
        assert "BroadcastHashJoin" not in _plan(join_small(big, wide, "k", "inner"))
        joins.BROADCAST_MAX_BYTES = 10 * joins.row_width(wide)
        assert "BroadcastHashJoin" in _plan(join_small(big, wide, "k", "inner"))
    finally:
        joins.BROADCAST_MAX_BYTES = limit
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rankings_and_counts_are_partial_aggregates(spark):
    df = _hot_movements(spark).withColumn("delay_minutes", F.col("delay_seconds") / 60)
    assert "partial_count" in _plan(stats.top_delayed(df))
    assert "TakeOrderedAndProject" in _plan(stats.top_avg_delay(df))


def test_landed_feed_scan_prunes_and_pushes_down(spark):
    i = Inputs(spark, SF_SMALL)
    plan = tf.extract_movements(i.feed)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(header.msg_type,0003)" in plan
    assert "canx_reason_code" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_location_join_is_broadcast(spark):
    i = Inputs(spark, SF_SMALL)
    assert "BroadcastHashJoin" in _plan(i.mv)
