"""Sinks (K-01 ... K-07).

Parquet tables are written per micro-batch into a ``batch_id`` partition with
dynamic partition overwrite, so replaying a batch replaces its own rows and
never duplicates them. JDBC writes are plain appends (at-least-once); readers
remove duplicates (``signalbox.operators.dedup``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox.functions.columns import epoch_ms_to_ts
from signalbox.operators.dedup import (
    dedup_cancellations_on_write,
    dedup_movements_on_write,
    keep_first,
)
from signalbox.operators.transforms import cancellation_rows, movement_rows
from signalbox.schemas import (
    ANOMALY_SCHEMA,
    CANCELLATION_TABLE_SCHEMA,
    MOVEMENT_TABLE_SCHEMA,
    jdbc_column_types,
)

BATCH_COLUMN = "batch_id"
DATE_COLUMN = "event_date"
MOVEMENT_TIME = "actual_timestamp"
CANCELLATION_TIME = "canx_timestamp"


# --- JDBC (K-01) --------------------------------------------------------------

def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: dict | None = None,
    column_types: str | None = None,
) -> None:
    """K-01: write through JDBC. Credentials and driver come from ``properties``."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


# --- Fact tables (K-02, K-03, K-05) ------------------------------------------

def movement_output(delay_with_location: DataFrame) -> DataFrame:
    """K-02: 10 table columns, one row per write-time key (D-01)."""
    return dedup_movements_on_write(movement_rows(delay_with_location))


def cancellation_output(cancellation_with_location: DataFrame) -> DataFrame:
    """K-03: 10 table columns, one row per write-time key (D-02)."""
    return dedup_cancellations_on_write(cancellation_rows(cancellation_with_location))


def write_batch_partition(df: DataFrame, path: str, batch_id: int, time_col: str | None = None) -> None:
    """Write ``df`` as partition ``batch_id=<n>`` of a Parquet table (idempotent).

    With ``time_col`` (epoch ms) the table is also partitioned by the event's
    UTC date (``event_date=<d>/batch_id=<n>``), so time-range reads prune
    whole days. Dynamic overwrite replaces only the partitions this batch
    writes, so a replayed batch replaces its own rows.
    """
    out = df.withColumn("inserted_at", F.current_timestamp().cast("timestamp_ntz")).withColumn(
        BATCH_COLUMN, F.lit(int(batch_id)).cast("long")
    )
    parts = [BATCH_COLUMN]
    if time_col is not None:
        out = out.withColumn(DATE_COLUMN, F.to_date(epoch_ms_to_ts(time_col)))
        parts = [DATE_COLUMN, BATCH_COLUMN]
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def write_by_batch(df: DataFrame, path: str) -> None:
    """Write ``df`` into the partitions that its column ``batch_id`` names; each replaces what it held."""
    (
        df.withColumn("inserted_at", F.current_timestamp().cast("timestamp_ntz"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(path)
    )


class ParquetFactSink:
    """Movement and cancellation tables under one base folder."""

    def __init__(self, base_path: str):
        self.base_path = base_path.rstrip("/")

    @property
    def movements_path(self) -> str:
        return f"{self.base_path}/raw_train_movements"

    @property
    def cancellations_path(self) -> str:
        return f"{self.base_path}/raw_train_cancellations"

    def write(self, movements: DataFrame, cancellations: DataFrame, batch_id: int) -> None:
        write_batch_partition(movement_output(movements), self.movements_path, batch_id, MOVEMENT_TIME)
        write_batch_partition(cancellation_output(cancellations), self.cancellations_path, batch_id,
                              CANCELLATION_TIME)

    def last_batch(self, spark: SparkSession) -> int:
        """Largest batch id in the tables (from the partition folders); -1 if there is none."""
        found = [-1]
        for path, reader in ((self.movements_path, self.read_movements_with_batch),
                             (self.cancellations_path, self.read_cancellations_with_batch)):
            fs, root = _hadoop_fs(spark, path)
            if fs.exists(root):
                found.append(reader(spark).agg(F.max(BATCH_COLUMN)).first()[0])
        return max(b for b in found if b is not None)

    def read_movements(self, spark: SparkSession) -> DataFrame:
        return read_fact_table(spark, self.movements_path, MOVEMENT_TABLE_SCHEMA)

    def read_cancellations(self, spark: SparkSession) -> DataFrame:
        return read_fact_table(spark, self.cancellations_path, CANCELLATION_TABLE_SCHEMA)

    def read_movements_with_batch(self, spark: SparkSession, since: int | None = None) -> DataFrame:
        """All columns including ``inserted_at`` and the partition columns, from batch ``since`` on."""
        return read_stored(spark, self.movements_path, MOVEMENT_TABLE_SCHEMA, since)

    def read_cancellations_with_batch(self, spark: SparkSession, since: int | None = None) -> DataFrame:
        return read_stored(spark, self.cancellations_path, CANCELLATION_TABLE_SCHEMA, since)

    def fold_days(self, spark: SparkSession, before, through: int | None = None, grace_seconds: float = 86_400) -> None:
        """Fold the batch folders of the days before ``before`` and remove those folded ``grace_seconds`` ago.

        ``through``: the last batch to fold; by default the last but one of the tables.
        """
        from signalbox.sinks.layout import FoldedTable

        through = self.last_batch(spark) - 1 if through is None else through
        for path, schema, time_col in ((self.movements_path, MOVEMENT_TABLE_SCHEMA, MOVEMENT_TIME),
                                       (self.cancellations_path, CANCELLATION_TABLE_SCHEMA, CANCELLATION_TIME)):
            fs, root = _hadoop_fs(spark, path)
            if fs.exists(root):
                table = FoldedTable(spark, path, schema)
                table.fold(before, through, time_col)
                table.retire(grace_seconds)


def stored_schema(schema: T.StructType, dated: bool = False) -> T.StructType:
    """Table schema plus insert time and partition columns."""
    extra = [T.StructField("inserted_at", T.TimestampNTZType())]
    if dated:
        extra.append(T.StructField(DATE_COLUMN, T.DateType()))
    extra.append(T.StructField(BATCH_COLUMN, T.LongType()))
    return T.StructType(schema.fields + extra)


def read_fact_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all batches (fixed schema), with the insert time kept for the
    read-time dedup order."""
    return read_stored(spark, path, schema).select(*schema.fieldNames(), "inserted_at")


def read_stored(spark: SparkSession, path: str, schema: T.StructType, since: int | None = None) -> DataFrame:
    """A dated fact table with all stored columns: folded days and batch folders (``sinks.layout``)."""
    from signalbox.sinks.layout import FoldedTable

    return FoldedTable(spark, path, schema).read(since)


class JdbcFactSink:
    """Movement and cancellation tables in a database (append, at-least-once)."""

    def __init__(self, url: str, properties: dict | None = None,
                 movements_table: str = "raw_train_movements",
                 cancellations_table: str = "raw_train_cancellations"):
        self.url = url
        self.properties = properties or {}
        self.movements_table = movements_table
        self.cancellations_table = cancellations_table

    def write(self, movements: DataFrame, cancellations: DataFrame, batch_id: int) -> None:
        write_jdbc(movement_output(movements), self.url, self.movements_table, "append",
                   self.properties, jdbc_column_types(MOVEMENT_TABLE_SCHEMA))
        write_jdbc(cancellation_output(cancellations), self.url, self.cancellations_table, "append",
                   self.properties, jdbc_column_types(CANCELLATION_TABLE_SCHEMA))

    def read_movements(self, spark: SparkSession) -> DataFrame:
        return read_jdbc(spark, self.url, self.movements_table, self.properties)

    def read_cancellations(self, spark: SparkSession) -> DataFrame:
        return read_jdbc(spark, self.url, self.cancellations_table, self.properties)


# --- Corrupt messages (S-11) --------------------------------------------------

QUARANTINE_SCHEMA = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("raw_text", T.StringType())])


def write_quarantine(corrupt: DataFrame, path: str, batch_id: int) -> None:
    """Corrupt texts of one batch; writing the batch again replaces them."""
    write_batch_partition(corrupt.select("file_path", "raw_text"), path, batch_id)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Corrupt texts of all batches with file_path, inserted_at and batch_id (empty before the first)."""
    schema = stored_schema(QUARANTINE_SCHEMA)
    fs, root = _hadoop_fs(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(root) else spark.createDataFrame([], schema)


# --- Anomaly table (K-04) ----------------------------------------------------

def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def replace_snapshot(df: DataFrame, path: str) -> str:
    """K-04: replace a table's contents by writing a new complete snapshot.

    Each call writes ``<path>/v=<millis>``; readers use the newest snapshot
    that finished (``_SUCCESS`` present), so they never see a partly written
    or empty table. An empty ``df`` writes an empty snapshot.
    """
    version = f"{path.rstrip('/')}/v={int(time.time() * 1000):015d}"
    df.select(*[F.col(f.name).cast(f.dataType) for f in ANOMALY_SCHEMA.fields]).write.mode(
        "errorifexists"
    ).parquet(version)
    return version


def _finished_snapshots(spark: SparkSession, path: str) -> list[str]:
    """Finished snapshot folders (``_SUCCESS`` present), oldest first."""
    fs, root = _hadoop_fs(spark, path)
    if not fs.exists(root):
        return []
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(
        s.getPath().toString()
        for s in fs.listStatus(root)
        if s.isDirectory() and s.getPath().getName().startswith("v=")
        and fs.exists(hpath(s.getPath(), "_SUCCESS"))
    )


def current_snapshot(spark: SparkSession, path: str) -> str | None:
    done = _finished_snapshots(spark, path)
    return done[-1] if done else None


def prune_snapshots(
    spark: SparkSession, path: str, keep: int = 3, older_than_seconds: float = 0
) -> list[str]:
    """Delete all but the newest ``keep`` finished snapshots; returns the deleted ones.

    Keeping more than one lets readers that started on an older snapshot
    finish; a snapshot also stays until ``older_than_seconds`` have passed
    since the next one was published. Unfinished folders (a failed write) older than the current
    snapshot are deleted too; newer unfinished ones may still be in progress.
    """
    done = _finished_snapshots(spark, path)
    if not done:
        return []
    fs, root = _hadoop_fs(spark, path)
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    limit = (time.time() - older_than_seconds) * 1000
    published = [int(hpath(d).getName().removeprefix("v=")) for d in done]
    old = [d for d, successor in zip(done[: max(0, len(done) - max(keep, 1))], published[1:])
           if successor <= limit]
    current = hpath(done[-1]).getName()
    finished = {hpath(d).getName() for d in done}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v=") and name not in finished and name < current:
            old.append(status.getPath().toString())
    for folder in old:
        fs.delete(hpath(folder), True)
    return old


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete anomaly snapshot (empty typed frame if none)."""
    current = current_snapshot(spark, path)
    if current is None:
        return spark.createDataFrame([], ANOMALY_SCHEMA)
    return spark.read.schema(ANOMALY_SCHEMA).parquet(current)


def replace_jdbc_table(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """K-04 on a database: truncate-and-insert keeping the table definition.

    Note: truncate and insert are separate steps, so readers can briefly see an
    empty table; use the Parquet snapshot where that matters.
    """
    props = {**(properties or {}), "truncate": "true"}
    write_jdbc(df.select(*ANOMALY_SCHEMA.fieldNames()), url, table, "overwrite", props,
               jdbc_column_types(ANOMALY_SCHEMA))


# --- Window statistics (K-07) ------------------------------------------------

WINDOW_KEY = ["window_start", "station"]
WINDOW_RESULT_STORED = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("station", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("avg_delay", T.DoubleType()),
        T.StructField("cancellation_count", T.LongType()),
    ]
)


def write_window_updates(updates: DataFrame, path: str, batch_id: int) -> None:
    """K-07: store the window rows changed in one trigger (update mode)."""
    write_batch_partition(updates, path, batch_id)


def late_windows_path(path: str) -> str:
    """Where the windows of late rows are counted anew, beside the stream's table."""
    return f"{path.rstrip('/')}/_late"


def read_window_stats(spark: SparkSession, path: str) -> DataFrame:
    """Current window statistics: for each (window, station) the latest batch wins.

    Windows that were counted anew for late rows stand above those of the
    stream, which has closed them.
    """
    def stored(folder: str, late: bool) -> DataFrame:
        rows = spark.read.schema(stored_schema(WINDOW_RESULT_STORED)).parquet(folder)
        return rows.drop("inserted_at").withColumn("late", F.lit(late))

    rows, late = stored(path, False), late_windows_path(path)
    fs, folder = _hadoop_fs(spark, late)
    if fs.exists(folder) and any(s.getPath().getName().startswith(BATCH_COLUMN) for s in fs.listStatus(folder)):
        rows = rows.unionByName(stored(late, True))
    latest = keep_first(rows, WINDOW_KEY, [~F.col("late"), -F.col(BATCH_COLUMN)])
    return latest.select(*WINDOW_RESULT_STORED.fieldNames())
