"""The 10-minute partials of the cascade, kept up to date batch by batch.

Each call counts the rows that its batches added to the clean tables and
stores the partials of every batch as a partition; no fact is read twice and
no other partial is rewritten. A batch that is worked on again, alone or in a
longer range, replaces its own partition. Readers add up all batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalbox.operators.rollup import PARTIAL_SCHEMA, bucket_partials, merge_partials
from signalbox.sinks.writers import BATCH_COLUMN, stored_schema, write_by_batch
from signalbox.streaming.progress import BatchStep


class RollupStep(BatchStep):
    """``after_write`` step behind an ``IncrementalClean``."""

    READERS = ()

    def __init__(self, spark: SparkSession, clean, path: str, then=None):
        super().__init__(spark, None, f"{path.rstrip('/')}/_rollup", then)
        self.clean = clean
        self.path = path.rstrip("/")

    def process(self, first: int, last: int) -> None:
        added = [self.clean.added(kind, first, last) for kind in ("movements", "cancellations")]
        write_by_batch(bucket_partials(*added, by=(BATCH_COLUMN,)), self.path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """Partials of all batches, one row per (bucket, station)."""
    return merge_partials(spark.read.schema(stored_schema(PARTIAL_SCHEMA)).parquet(path))
