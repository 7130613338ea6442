"""Feed-shaped inputs derived from the provided test tables.

The provided tables carry no rail feed, so movement and cancellation messages
are derived from ``events`` and the reference dimensions from ``nation`` and
``supplier``. The same definitions are written as SQL in
``signalbox.plans.oracle`` for the independent check.

* ``events`` -> one feed message per event: ``error`` -> cancellation (0002),
  ``signup`` -> activation (0001, ignored by the extractors), others ->
  movement (0003). Train = user, location = ``user_id % 30`` (five codes
  without a location record), delay = ``value - 40`` minutes.
* ``nation`` -> one main location record per nation (every fifth has an
  empty station code); ``supplier`` -> extra records per location (padded
  codes, blank codes, no station code), so the dimension has many rows per
  key and grows with the data.
* Coordinates: one record per station from ``nation`` (station 24 has none),
  followed by later, lower-priority records from ``supplier``; some carry
  text that is not a number.
* Replay: every message whose event id is a multiple of ten is delivered a
  second time (at-least-once delivery); the deduplicating operators must
  remove these copies. This adds rows, it never removes any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbox.functions.columns import ts_to_epoch_ms

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, replay: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if replay:
        # One scan: replayed events are emitted twice by a generator.
        copies = F.when(F.col("event_id") % 10 == 0, F.lit(2)).otherwise(F.lit(1))
        ev = ev.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("__copy")).drop("__copy")
    return ev


def _s(c):
    return c.cast("string")


def feed_from_events(ev: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events -> parsed feed messages (``header``/``body`` structs).

    Equivalent to reading the landed JSON files with ``FEED_SCHEMA``.
    """
    planned_ms = ts_to_epoch_ms("ts")
    shift = F.round(F.col("value") - F.lit(40.0))
    msg_type = (
        F.when(F.col("event_type") == "error", F.lit("0002"))
        .when(F.col("event_type") == "signup", F.lit("0001"))
        .otherwise(F.lit("0003"))
    )
    is_mv = msg_type == "0003"
    is_cx = msg_type == "0002"
    actual_ms = planned_ms + F.round((F.col("value") - F.lit(40.0)) * F.lit(60000.0)).cast("long")
    status = (
        F.when(shift > 0, F.lit("LATE")).when(shift < 0, F.lit("EARLY")).otherwise(F.lit("ON TIME"))
    )
    canx_type = (
        F.when(F.col("event_id") % 3 == 0, F.lit("AT ORIGIN"))
        .when(F.col("event_id") % 3 == 1, F.lit("EN ROUTE"))
        .otherwise(F.lit("AT CALL"))
    )
    header = F.struct(
        msg_type.alias("msg_type"),
        _s(planned_ms).alias("msg_queue_timestamp"),
        F.concat(F.lit("SRC"), _s(F.col("user_id") % 3)).alias("source_system_id"),
    )
    body = F.struct(
        F.concat(F.lit("T"), _s(F.col("user_id"))).alias("train_id"),
        F.concat(F.lit("S"), _s(F.col("event_id") % 7)).alias("train_service_code"),
        _s(F.col("user_id") % 4).alias("toc_id"),
        F.lpad(_s(F.col("user_id") % 30), 5, "0").alias("loc_stanox"),
        F.when(is_cx, _s(planned_ms)).alias("canx_timestamp"),
        F.when(is_cx, F.get_json_object("props", "$.k")).alias("canx_reason_code"),
        F.when(is_cx, canx_type).alias("canx_type"),
        F.when(is_mv, _s(actual_ms)).alias("actual_timestamp"),
        F.when(is_mv, _s(planned_ms)).alias("planned_timestamp"),
        F.when(is_mv, _s(F.abs(shift).cast("int"))).alias("timetable_variation"),
        F.when(is_mv, status).alias("variation_status"),
        F.when(is_mv, F.when(F.col("event_type") == "click", F.lit("ARRIVAL")).otherwise(F.lit("DEPARTURE"))).alias("event_type"),
    )
    return ev.select(header.alias("header"), body.alias("body"), *keep)


def feed(spark: SparkSession, sf_dir: str, replay: bool = False) -> DataFrame:
    return feed_from_events(events(spark, sf_dir, replay))


def feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed message text (``value``), one JSON object per message."""
    return feed(spark, sf_dir).select(F.to_json(F.struct("header", "body")).alias("value"))


def cut_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message text cut off in transit: every activation (0001) frame arrives
    a second time without its last character, which is not valid JSON."""
    text = feed(spark, sf_dir).select(
        F.col("header.msg_type").alias("msg_type"),
        F.to_json(F.struct("header", "body")).alias("value"),
    )
    return text.filter(F.col("msg_type") == "0001").select(
        F.expr("substring(value, 1, length(value) - 1)").alias("value")
    )


def landing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message text as received, including the cut-off frames."""
    return feed_text(spark, sf_dir).unionByName(cut_frames(spark, sf_dir))


def location_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw location records (``STANOX``, ``TIPLOC``, ``3ALPHA``, ``NLCDESC``, ``NLCDESC16``)."""
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier")
    key = F.col("n_nationkey")
    main = n.select(
        F.lpad(_s(key), 5, "0").alias("STANOX"),
        F.concat(F.lit("TPL"), _s(key)).alias("TIPLOC"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("A"), F.lpad(_s(key), 2, "0"))).alias("3ALPHA"),
        F.col("n_name").alias("NLCDESC"),
        F.substring("n_name", 1, 16).alias("NLCDESC16"),
    )
    skey = F.col("s_nationkey")
    extra = s.select(
        F.when(F.col("s_acctbal") < 0, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.lpad(_s(skey), 5, "0"), F.lit(" ")))
        .alias("STANOX"),
        F.concat(F.lit("TPL"), _s(skey), F.lit("S"), _s(F.col("s_suppkey"))).alias("TIPLOC"),
        F.lit(None).cast("string").alias("3ALPHA"),
        F.col("s_name").alias("NLCDESC"),
        F.substring("s_name", 1, 16).alias("NLCDESC16"),
    )
    return main.unionByName(extra)


def coordinate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw coordinate records (``3alpha``, ``station_name``, text ``latitude``/``longitude``, ``record_no``).

    Every twelfth nation's records carry a code that no location has, so its
    station has no coordinates.
    """
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier")

    def code(key):
        return F.concat(F.when(key % 12 == 0, F.lit("Z")).otherwise(F.lit("A")), F.lpad(_s(key), 2, "0"))

    key = F.col("n_nationkey")
    main = n.select(
        code(key).alias("3alpha"),
        F.when(key % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("station_name"),
        _s(F.lit(50.0) + key.cast("double") * F.lit(0.3)).alias("latitude"),
        _s(F.lit(-5.0) + key.cast("double") * F.lit(0.25)).alias("longitude"),
        key.cast("long").alias("record_no"),
    )
    skey = F.col("s_nationkey")
    extra = s.select(
        code(skey).alias("3alpha"),
        F.col("s_name").alias("station_name"),
        F.when(F.col("s_acctbal") < 0, F.lit("n/a")).otherwise(_s(F.lit(49.0) + skey.cast("double") * F.lit(0.3))).alias("latitude"),
        _s(F.lit(-6.0) + skey.cast("double") * F.lit(0.25)).alias("longitude"),
        (F.lit(1000) + F.col("s_suppkey")).cast("long").alias("record_no"),
    )
    return main.unionByName(extra)
