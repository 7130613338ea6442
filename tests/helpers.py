"""Builders for hand-made feed rows."""

from pyspark.sql import Row

from signalbox.schemas import FEED_SCHEMA, MOVEMENT_TABLE_SCHEMA, CANCELLATION_TABLE_SCHEMA

BODY_FIELDS = FEED_SCHEMA["body"].dataType.fieldNames()


def message(msg_type="0003", **body):
    header = Row(msg_type=msg_type, msg_queue_timestamp="1", source_system_id="TRUST")
    values = {f: body.get(f) for f in BODY_FIELDS}
    return (header, Row(**values))


def feed_df(spark, messages):
    return spark.createDataFrame(messages, FEED_SCHEMA)


def movement(train="T1", stanox="00001", planned=0, actual=0, status="ON TIME", event_type="ARRIVAL"):
    return message(
        "0003", train_id=train, loc_stanox=stanox, planned_timestamp=None if planned is None else str(planned),
        actual_timestamp=None if actual is None else str(actual), variation_status=status,
        event_type=event_type, timetable_variation="0",
    )


def movement_table(spark, rows):
    """Rows of (train, stanox, tiploc, alpha3, name, event_type, planned, actual, status, delay)."""
    return spark.createDataFrame(rows, MOVEMENT_TABLE_SCHEMA)


def cancellation_table(spark, rows):
    """Rows of (train, service, toc, stanox, tiploc, alpha3, name, canx_ts, reason, type)."""
    return spark.createDataFrame(rows, CANCELLATION_TABLE_SCHEMA)


HOUR_MS = 3_600_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
