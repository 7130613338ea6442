"""Fixed schemas for every source and table (no inference)."""

from pyspark.sql import types as T

_S = T.StringType()

# Feed message: {header, body}; every leaf is a nullable string.
FEED_BODY_SCHEMA = T.StructType(
    [
        T.StructField("train_id", _S),
        T.StructField("train_service_code", _S),
        T.StructField("toc_id", _S),
        T.StructField("loc_stanox", _S),
        # cancellation (0002) fields
        T.StructField("canx_timestamp", _S),
        T.StructField("canx_reason_code", _S),
        T.StructField("canx_type", _S),
        # movement (0003) fields
        T.StructField("actual_timestamp", _S),
        T.StructField("planned_timestamp", _S),
        T.StructField("timetable_variation", _S),
        T.StructField("variation_status", _S),
        T.StructField("event_type", _S),
    ]
)

FEED_HEADER_SCHEMA = T.StructType(
    [
        T.StructField("msg_type", _S),
        T.StructField("msg_queue_timestamp", _S),
        T.StructField("source_system_id", _S),
    ]
)

FEED_SCHEMA = T.StructType(
    [
        T.StructField("header", FEED_HEADER_SCHEMA),
        T.StructField("body", FEED_BODY_SCHEMA),
    ]
)

CORRUPT_COLUMN = "_corrupt_record"

# Location reference file: {"TIPLOCDATA": [ {STANOX, TIPLOC, 3ALPHA, NLCDESC, NLCDESC16}, ... ]}
LOCATION_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("STANOX", _S),
        T.StructField("TIPLOC", _S),
        T.StructField("3ALPHA", _S),
        T.StructField("NLCDESC", _S),
        T.StructField("NLCDESC16", _S),
    ]
)
CORPUS_SCHEMA = T.StructType(
    [T.StructField("TIPLOCDATA", T.ArrayType(LOCATION_RECORD_SCHEMA))]
)

LOCATION_DIM_SCHEMA = T.StructType(
    [
        T.StructField("stanox", _S),
        T.StructField("tiploc", _S),
        T.StructField("alpha3", _S),
        T.StructField("local_name", _S),
        T.StructField("local_name_short", _S),
    ]
)

# Station coordinate file: JSON array of flat records. Numbers may arrive as
# text, so they are read as strings and coerced.
COORDINATE_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("3alpha", _S),
        T.StructField("alpha3", _S),
        T.StructField("station_name", _S),
        T.StructField("latitude", _S),
        T.StructField("longitude", _S),
    ]
)

COORDINATE_SCHEMA = T.StructType(
    [
        T.StructField("alpha3", _S),
        T.StructField("station_name", _S),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

# Fact tables as written by the sinks (K-05).
MOVEMENT_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("train_id", _S),
        T.StructField("loc_stanox", _S),
        T.StructField("tiploc", _S),
        T.StructField("alpha3", _S),
        T.StructField("local_name", _S),
        T.StructField("event_type", _S),
        T.StructField("planned_timestamp", T.LongType()),
        T.StructField("actual_timestamp", T.LongType()),
        T.StructField("variation_status", _S),
        T.StructField("delay_seconds", T.DoubleType()),
    ]
)

CANCELLATION_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("train_id", _S),
        T.StructField("train_service_code", _S),
        T.StructField("toc_id", _S),
        T.StructField("loc_stanox", _S),
        T.StructField("tiploc", _S),
        T.StructField("alpha3", _S),
        T.StructField("local_name", _S),
        T.StructField("canx_timestamp", T.LongType()),
        T.StructField("canx_reason_code", _S),
        T.StructField("canx_type", _S),
    ]
)

ANOMALY_SCHEMA = T.StructType(
    [
        T.StructField("event_source", _S),
        T.StructField("train_id", _S),
        T.StructField("alpha3", _S),
        T.StructField("loc_stanox", _S),
        T.StructField("local_name", _S),
        T.StructField("event_type", _S),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("delay_seconds", T.DoubleType()),
        T.StructField("anomaly_type", _S),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("explanation", _S),
    ]
)

MOVEMENT_COLUMNS = [f.name for f in MOVEMENT_TABLE_SCHEMA.fields]
CANCELLATION_COLUMNS = [f.name for f in CANCELLATION_TABLE_SCHEMA.fields]
ANOMALY_COLUMNS = [f.name for f in ANOMALY_SCHEMA.fields]

# Window-aggregate prototype input (CSV with header) and its result.
WINDOW_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("train_id", _S),
        T.StructField("station", _S),
        T.StructField("route", _S),
        T.StructField("delay_minutes", T.IntegerType()),
        T.StructField("is_cancelled", T.IntegerType()),
    ]
)

WINDOW_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("station", _S),
        T.StructField("event_count", T.LongType()),
        T.StructField("avg_delay", T.DoubleType()),
        T.StructField("cancellation_count", T.LongType()),
    ]
)


def jdbc_column_types(schema: T.StructType) -> str:
    """``createTableColumnTypes`` string for a JDBC table (K-05).

    Text columns are left to the database dialect (e.g. TEXT, CLOB), which
    also decides how nulls are bound.
    """
    names = {
        T.LongType: "BIGINT",
        T.IntegerType: "INTEGER",
        T.DoubleType: "DOUBLE",
        T.TimestampType: "TIMESTAMP",
        T.TimestampNTZType: "TIMESTAMP",
    }
    return ", ".join(
        f"{f.name} {names[type(f.dataType)]}" for f in schema.fields if type(f.dataType) in names
    )
