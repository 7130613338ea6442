"""Incremental clean (deduplicated) fact tables.

A full refresh re-deduplicates the whole history. This step instead folds one
ingested micro-batch into the clean table: the batch is deduplicated on the
read-time key (D-03 / D-04), anti-joined (null-safe) with the clean rows of
only the event dates the batch touches (partition pruning), and the remaining
rows are appended under ``event_date=<d>``. Earlier deliveries win, exactly
as in the read-time dedup ordered by insert time; folding a batch again
appends nothing, so batches whose fold failed are taken up by the next call.

Each clean row keeps the number of the batch that brought it, so a later step
can read what a range of batches added (``IncrementalClean.added``): each
file holds the rows of one fold, and its statistics let a scan skip all
others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox.operators.dedup import CANCELLATION_READ_KEY, MOVEMENT_READ_KEY, keep_first
from signalbox.operators.joins import join_small
from signalbox.schemas import CANCELLATION_TABLE_SCHEMA, MOVEMENT_TABLE_SCHEMA
from signalbox.sinks.writers import BATCH_COLUMN, DATE_COLUMN, _hadoop_fs
from signalbox.streaming.progress import BatchStep, in_batches

KINDS = {
    "movements": (MOVEMENT_TABLE_SCHEMA, MOVEMENT_READ_KEY, "read_movements_with_batch"),
    "cancellations": (CANCELLATION_TABLE_SCHEMA, CANCELLATION_READ_KEY, "read_cancellations_with_batch"),
}


def clean_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        schema.fields + [T.StructField(BATCH_COLUMN, T.LongType()), T.StructField(DATE_COLUMN, T.DateType())])


def read_clean_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema = KINDS[kind][0]
    return spark.read.schema(clean_schema(schema)).parquet(path).select(*schema.fieldNames())


def fold_batches(spark: SparkSession, sink, clean_path: str, first: int, last: int, kind: str) -> None:
    """Append the new rows of the batches ``first`` to ``last`` to the clean table of ``kind``."""
    schema, key, reader = KINDS[kind]
    table = getattr(sink, reader)(spark, since=first)
    batches = table.filter(in_batches(first, last)).drop(BATCH_COLUMN)
    fresh = keep_first(batches, key, [F.col("inserted_at")]).drop("inserted_at")
    fs, root = _hadoop_fs(spark, clean_path)
    if fs.exists(root):
        days = fresh.select(F.col(DATE_COLUMN).alias("touched_day")).distinct()
        existing = spark.read.schema(clean_schema(schema)).parquet(clean_path).select(*key, DATE_COLUMN)
        # Only touched days; rows without a date are a day of their own.
        existing = join_small(
            existing, days, existing[DATE_COLUMN].eqNullSafe(days["touched_day"]), "left_semi")
        cond = reduce(lambda a, b: a & b,
                      [fresh[c].eqNullSafe(existing[c]) for c in key + [DATE_COLUMN]])
        fresh = fresh.join(existing, cond, "left_anti")
    fresh.select(*schema.fieldNames(), F.lit(last).cast("long").alias(BATCH_COLUMN), DATE_COLUMN).write.mode(
        "append").partitionBy(DATE_COLUMN).parquet(clean_path)


class IncrementalClean(BatchStep):
    """``after_write`` step: fold each batch into both clean tables."""

    def __init__(self, spark: SparkSession, sink, base_path: str, then=None):
        super().__init__(spark, sink, base_path, then)
        self.base = base_path.rstrip("/")

    def path(self, kind: str) -> str:
        return f"{self.base}/{kind}"

    def history(self, kind: str) -> DataFrame:
        """All clean rows, with the columns batch_id and event_date."""
        return self.spark.read.schema(clean_schema(KINDS[kind][0])).parquet(self.path(kind))

    def added(self, kind: str, first: int, last: int) -> DataFrame:
        """Clean rows that the folds of the batches ``first`` to ``last`` brought."""
        return self.history(kind).filter(in_batches(first, last))

    def process(self, first: int, last: int) -> None:
        for kind in KINDS:
            fold_batches(self.spark, self.sink, self.path(kind), first, last, kind)
