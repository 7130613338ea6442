"""Database sinks with transactions (K-01, K-04 ... K-06).

Spark's JDBC writer commits every partition by itself, so a table written
directly shows half a batch, doubles rows when a task or batch is repeated,
and stands empty while it is replaced. Here Spark writes to a staging table,
in parallel as usual; one transaction on a single connection of the driver
then moves the rows inside the database:

* ``replace_table``: delete and refill. Readers see the old rows or the new
  ones; if anything fails before the commit, the old rows stay.
* ``JdbcBatchSink``: delete and insert of one batch of both fact tables, with
  the batch's row in a ledger. Writing a batch again replaces it, and single
  batches can be read back, as ``BatchStep`` needs.

No row passes through the driver. Tables get a generated key and an insert
time that the database sets, which column types of the writer cannot state.
Statements are plain SQL; column names are quoted, as Spark's writer does.
The connection is opened in Spark's JVM (not available under Spark Connect).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox.functions.columns import epoch_ms_to_ts
from signalbox.schemas import ANOMALY_SCHEMA, CANCELLATION_TABLE_SCHEMA, MOVEMENT_TABLE_SCHEMA, jdbc_column_types
from signalbox.sinks.writers import (
    BATCH_COLUMN,
    CANCELLATION_TIME,
    DATE_COLUMN,
    MOVEMENT_TIME,
    cancellation_output,
    movement_output,
    stored_schema,
    write_jdbc,
)

KEY_COLUMN = "id"
INSERT_TIME = "inserted_at"
ANOMALY_INSERT_TIME = "detected_at"
LEDGER = "ingested_batches"

_SQL_TYPES = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.DoubleType: "DOUBLE PRECISION",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
}
#: Databases without a TEXT type; the type must be the one that Spark's writer takes for text.
_TEXT_TYPES = {"Apache Derby": "CLOB"}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _names(columns) -> str:
    return ", ".join(quoted(c) for c in columns)


class Database:
    """Connections, definitions and transactions of one database."""

    def __init__(self, spark: SparkSession, url: str, properties: dict | None = None):
        self.spark = spark
        self.url = url
        self.properties = properties or {}

    @contextmanager
    def connection(self) -> Iterator:
        jvm = self.spark.sparkContext._jvm
        if "driver" in self.properties:
            jvm.java.lang.Class.forName(self.properties["driver"])
        props = jvm.java.util.Properties()
        for key, value in self.properties.items():
            if key != "driver":
                props.setProperty(key, str(value))
        opened = jvm.java.sql.DriverManager.getConnection(self.url, props)
        try:
            yield opened
        finally:
            opened.close()

    def transaction(self, statements: list[str]) -> list[int]:
        """Run all statements or none; the rows that each touched."""
        with self.connection() as c:
            c.setAutoCommit(False)
            try:
                statement = c.createStatement()
                counts = [statement.executeUpdate(s) for s in statements]
                c.commit()
            except BaseException:
                c.rollback()
                raise
        return counts

    def exists(self, table: str) -> bool:
        with self.connection() as c:
            meta = c.getMetaData()
            for name in {table, table.upper(), table.lower()}:
                found = meta.getTables(None, None, name, None)
                if found.next():
                    return True
        return False

    def column_definitions(self, schema: T.StructType) -> list[str]:
        with self.connection() as c:
            text = _TEXT_TYPES.get(c.getMetaData().getDatabaseProductName(), "TEXT")
        return [f"{quoted(f.name)} {_SQL_TYPES.get(type(f.dataType), text)}" for f in schema.fields]

    def ensure_table(self, table: str, schema: T.StructType, insert_time: str | None = INSERT_TIME,
                     batches: bool = False) -> None:
        """K-05: create the table if it is missing: generated key, the columns, insert time by default.

        ``batches`` adds the batch id with an index.
        """
        if self.exists(table):
            return
        columns = [f"{quoted(KEY_COLUMN)} BIGINT GENERATED ALWAYS AS IDENTITY PRIMARY KEY",
                   *self.column_definitions(schema)]
        if batches:
            columns.append(f"{quoted(BATCH_COLUMN)} BIGINT NOT NULL")
        if insert_time:
            columns.append(f"{quoted(insert_time)} TIMESTAMP DEFAULT CURRENT_TIMESTAMP")
        made = [f"CREATE TABLE {table} ({', '.join(columns)})"]
        if batches:
            made.append(f"CREATE INDEX {table}_by_batch ON {table} ({quoted(BATCH_COLUMN)})")
        self.transaction(made)

    def stage(self, df: DataFrame, table: str, schema: T.StructType) -> str:
        """Write ``df`` to a new staging table of ``table``, with the writer's own column types; its name."""
        staging = f"{table}_staging"
        write_jdbc(df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), self.url, staging, "overwrite",
                   self.properties, jdbc_column_types(schema))
        return staging

    def replace_table(self, df: DataFrame, table: str, schema: T.StructType = ANOMALY_SCHEMA,
                      insert_time: str | None = ANOMALY_INSERT_TIME) -> int:
        """K-04: the rows of ``df`` instead of the table's, in one transaction; the number of new rows.

        The definition stays; an empty ``df`` leaves an empty table.
        """
        self.ensure_table(table, schema, insert_time)
        staging, names = self.stage(df, table, schema), _names(schema.fieldNames())
        counts = self.transaction([
            f"DELETE FROM {table}",
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
        ])
        self.transaction([f"DROP TABLE {staging}"])
        return counts[-1]


class JdbcBatchSink:
    """Movement and cancellation tables in a database, one transaction a batch (K-01, K-06).

    A batch that is delivered again replaces its own rows; the ledger tells
    which batches are in the tables, and with how many rows.
    """

    KINDS = {
        "movements": (MOVEMENT_TABLE_SCHEMA, movement_output, MOVEMENT_TIME),
        "cancellations": (CANCELLATION_TABLE_SCHEMA, cancellation_output, CANCELLATION_TIME),
    }
    LEDGER_SCHEMA = T.StructType([T.StructField("movements", T.LongType()), T.StructField("cancellations", T.LongType())])

    def __init__(self, spark: SparkSession, url: str, properties: dict | None = None,
                 movements_table: str = "raw_train_movements", cancellations_table: str = "raw_train_cancellations",
                 ledger: str = LEDGER, read_partitions: int = 8):
        self.db = Database(spark, url, properties)
        self.tables = {"movements": movements_table, "cancellations": cancellations_table}
        self.ledger = ledger
        self.read_partitions = read_partitions
        for kind, table in self.tables.items():
            self.db.ensure_table(table, self.KINDS[kind][0], batches=True)
        if not self.db.exists(ledger):
            self.db.transaction([
                f"CREATE TABLE {ledger} ({quoted(BATCH_COLUMN)} BIGINT PRIMARY KEY, "
                + ", ".join(f"{quoted(k)} BIGINT NOT NULL" for k in self.tables)
                + f", {quoted(INSERT_TIME)} TIMESTAMP DEFAULT CURRENT_TIMESTAMP)"
            ])

    def write(self, movements: DataFrame, cancellations: DataFrame, batch_id: int) -> None:
        batch, moved, counts = int(batch_id), [], []
        for (kind, (schema, output, _)), df in zip(self.KINDS.items(), (movements, cancellations), strict=True):
            table, names = self.tables[kind], _names(schema.fieldNames())
            staging = self.db.stage(output(df), table, schema)
            moved += [
                f"DELETE FROM {table} WHERE {quoted(BATCH_COLUMN)} = {batch}",
                f"INSERT INTO {table} ({names}, {quoted(BATCH_COLUMN)}) SELECT {names}, {batch} FROM {staging}",
            ]
            counts.append(f"(SELECT COUNT(*) FROM {staging})")
        moved += [
            f"DELETE FROM {self.ledger} WHERE {quoted(BATCH_COLUMN)} = {batch}",
            f"INSERT INTO {self.ledger} ({_names([BATCH_COLUMN, *self.tables])}) VALUES ({batch}, {', '.join(counts)})",
        ]
        self.db.transaction(moved)

    def batches(self) -> DataFrame:
        """The ledger: batch_id, rows of both tables, insert time."""
        from signalbox.sources.tables import read_table

        return read_table(self.db.spark, self.ledger, jdbc_url=self.db.url, properties=self.db.properties)

    def last_batch(self, spark: SparkSession) -> int:
        """Largest batch id in the tables; -1 if there is none."""
        last = self.batches().agg(F.max(BATCH_COLUMN)).first()[0]
        return -1 if last is None else last

    def _read(self, kind: str) -> DataFrame:
        """All rows with insert time, event date and batch id; the read is split on the generated key."""
        from signalbox.sources.tables import read_table

        schema, _, time_column = self.KINDS[kind]
        rows = read_table(self.db.spark, self.tables[kind], jdbc_url=self.db.url, properties=self.db.properties,
                          partition_column=KEY_COLUMN, num_partitions=self.read_partitions)
        dated = rows.withColumn(DATE_COLUMN, F.to_date(epoch_ms_to_ts(time_column)))
        return dated.select(*[F.col(f.name).cast(f.dataType) for f in stored_schema(schema, dated=True).fields])

    def read_movements_with_batch(self, spark: SparkSession, since: int | None = None) -> DataFrame:
        rows = self._read("movements")
        return rows if since is None else rows.filter(F.col(BATCH_COLUMN) >= since)

    def read_cancellations_with_batch(self, spark: SparkSession, since: int | None = None) -> DataFrame:
        rows = self._read("cancellations")
        return rows if since is None else rows.filter(F.col(BATCH_COLUMN) >= since)

    def read_movements(self, spark: SparkSession) -> DataFrame:
        return self._read("movements").select(*MOVEMENT_TABLE_SCHEMA.fieldNames(), INSERT_TIME)

    def read_cancellations(self, spark: SparkSession) -> DataFrame:
        return self._read("cancellations").select(*CANCELLATION_TABLE_SCHEMA.fieldNames(), INSERT_TIME)
