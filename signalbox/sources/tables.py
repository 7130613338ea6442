"""Stored-table and CSV sources (S-07, S-08, S-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox.schemas import WINDOW_EVENT_SCHEMA, WINDOW_RESULT_SCHEMA


def _jdbc(spark: SparkSession, url: str, table: str, properties: dict | None):
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader


def key_predicates(
    spark: SparkSession, url: str, table: str, column: str, partitions: int, properties: dict | None = None
) -> list[str]:
    """Conditions that cut a table into up to ``partitions`` ranges of about equal numbers of rows.

    The database gives the key's least and greatest value and the counts; the
    key column alone is read in equal widths and sketched
    (``percentile_approx``); the ranges lie between the sketch's distinct
    quantiles. Every bound is a value of the table, so no range is empty, and
    a value that many rows share gets one range. Rows without a key have a
    range of their own if there are any.
    """
    name = '"' + column.replace('"', '""') + '"'
    lo, hi, keyed, rows = _jdbc(
        spark, url, f"(SELECT MIN({name}) AS lo, MAX({name}) AS hi, COUNT({name}) AS keyed, COUNT(*) AS n FROM {table}) s",
        properties).load().first()
    nulls = [f"{name} IS NULL"] if rows > keyed else []
    if not keyed:
        return nulls or [f"{name} IS NOT NULL"]
    if not isinstance(lo, int):
        raise TypeError(f"{column} is no whole number; give bounds or another column")
    if lo == hi or partitions < 2:
        return [f"{name} IS NOT NULL", *nulls]
    width = max(1, -(-(hi - lo + 1) // partitions))
    coarse = [f"{name} >= {at} AND {name} < {at + width}" for at in range(lo, hi + 1, width)]
    keys = spark.read.jdbc(url, f"(SELECT {name} FROM {table}) k", predicates=coarse, properties=properties or {})
    shares = [i / partitions for i in range(1, partitions)]
    cuts = keys.agg(F.percentile_approx(F.col(f"`{column}`"), shares, 100 * partitions)).first()[0]
    cuts = sorted({int(c) for c in cuts} - {lo})
    if not cuts:
        return [f"{name} IS NOT NULL", *nulls]
    between = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{name} < {cuts[0]}", *between, f"{name} >= {cuts[-1]}", *nulls]


def read_table(
    spark: SparkSession,
    name: str,
    base_path: str | None = None,
    jdbc_url: str | None = None,
    properties: dict | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """S-08: a whole table from Parquet (``base_path/name``) or a database.

    For JDBC, ``partition_column`` and ``num_partitions`` split the read into
    parallel range queries: of equal width between ``bounds`` where they are
    given, else of about equal numbers of rows (``key_predicates``, with rows
    that have no key). Filters and projections applied later are pushed into
    the database query by Spark. With a ``schema``, a table that does not
    exist (yet) is an empty frame of that schema.
    """
    from signalbox.sinks.database import Database
    from signalbox.sinks.writers import _hadoop_fs

    if jdbc_url is None:
        path = f"{base_path.rstrip('/')}/{name}"
        if schema is None:
            return spark.read.parquet(path)
        fs, folder = _hadoop_fs(spark, path)
        return spark.read.schema(schema).parquet(path) if fs.exists(folder) else spark.createDataFrame([], schema)
    if schema is not None and not Database(spark, jdbc_url, properties).exists(name):
        return spark.createDataFrame([], schema)
    reader = _jdbc(spark, jdbc_url, name, properties)
    if partition_column and num_partitions and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", num_partitions)
        )
    elif partition_column and num_partitions:
        ranges = key_predicates(spark, jdbc_url, name, partition_column, num_partitions, properties)
        return spark.read.jdbc(jdbc_url, name, predicates=ranges, properties=properties or {})
    return reader.load()


def read_window_events(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of the CSV event files of the window aggregate."""
    return spark.read.option("header", "true").schema(WINDOW_EVENT_SCHEMA).csv(path)


def read_window_events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S-07: CSV event stream with header and fixed schema."""
    reader = spark.readStream.option("header", "true").schema(WINDOW_EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def read_latest_window_results(spark: SparkSession, path: str) -> DataFrame:
    """S-10: window-result CSV rows of the latest ``batch_<n>`` folder.

    The latest batch is the largest batch number (numeric, so ``batch_10``
    follows ``batch_9``) that holds a CSV file. Only that folder is read; the
    folder names alone decide which it is. No such folder: an empty frame.
    """
    from signalbox.sinks.writers import _hadoop_fs

    fs, root = _hadoop_fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(root)] if fs.exists(root) else []
    batches = [int(n.removeprefix("batch_")) for n in names if n.startswith("batch_") and n[6:].isdigit()]
    while batches:
        latest = max(batches)
        folder = f"{path.rstrip('/')}/batch_{latest}"
        if any(st.getPath().getName().endswith(".csv") for st in fs.listStatus(_hadoop_fs(spark, folder)[1])):
            return spark.read.option("header", "true").option("pathGlobFilter", "*.csv").schema(
                WINDOW_RESULT_SCHEMA).csv(folder)
        batches.remove(latest)  # a batch without results
    return spark.createDataFrame([], WINDOW_RESULT_SCHEMA)
