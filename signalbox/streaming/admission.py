"""Backlogs of the feed: what a trigger takes in, and whether all of it came out (T-04, T-06).

A trigger takes files up to a number or up to a number of bytes; after an
outage with few large files the bytes bound a batch, the number does not.
Files of committed batches can move to an archive, so the landing folder
holds the backlog alone. ``BatchCounts`` keeps, per batch, how many messages
of each kind came in and how many rows the writes really took, and stops the
stream where they differ (a location that matches twice, a lost write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox.constants import MSG_TYPE_CANCELLATION, MSG_TYPE_MOVEMENT
from signalbox.sinks.writers import _hadoop_fs, stored_schema, write_batch_partition

COUNT_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("messages", T.LongType()), T.StructField("written", T.LongType()),
    T.StructField("waiting_files", T.LongType()), T.StructField("waiting_bytes", T.LongType()),
])


def waiting(spark: SparkSession, folder: str) -> tuple[int, int]:
    """(files, bytes) of the message files in a landing folder.

    With an archive this is the backlog, the files of the running batch and
    those not yet moved included; without one it is all files ever landed.
    """
    fs, root = _hadoop_fs(spark, folder)
    files = [s.getLen() for s in fs.listStatus(root) if s.isFile() and s.getPath().getName().endswith(".json")]
    return len(files), sum(files)


class BatchCounts:
    """Messages in and rows out of each batch, as a table with one partition per batch.

    ``written`` counts the rows that the sink's own write of a kind consumed,
    before it removes duplicates, seen by Spark while the write runs. Other
    kinds are not written (null). ``landing``: the folder whose waiting files
    are reported with each batch.
    """

    KINDS = (MSG_TYPE_MOVEMENT, MSG_TYPE_CANCELLATION)
    OTHER = "other"

    def __init__(self, spark: SparkSession, path: str, landing: str | None = None):
        self.spark = spark
        self.path = path
        self.landing = landing

    def observed(self, *frames: DataFrame) -> tuple[list[DataFrame], list[Observation]]:
        """The frames of ``KINDS``, each with a count of its rows that the frame's next action fills."""
        seen = [Observation() for _ in frames]
        return [f.observe(o, F.count(F.lit(1)).alias("n")) for f, o in zip(frames, seen, strict=True)], seen

    def check(self, batch: DataFrame, seen: list[Observation], batch_id: int) -> None:
        """Store the counts of a written batch; raises if messages and written rows differ."""
        kind = F.when(F.col("header.msg_type").isin(*self.KINDS), F.col("header.msg_type")).otherwise(self.OTHER)
        came = {r[0]: r[1] for r in batch.groupBy(kind).count().collect()}
        out = {k: o.get["n"] for k, o in zip(self.KINDS, seen, strict=True)}
        files, size = waiting(self.spark, self.landing) if self.landing else (None, None)
        rows = [(k, came.get(k, 0), out.get(k), files, size) for k in (*self.KINDS, self.OTHER)]
        write_batch_partition(self.spark.createDataFrame(rows, COUNT_SCHEMA).coalesce(1), self.path, batch_id)
        wrong = [f"{k}: {messages} in, {written} out" for k, messages, written, _, _ in rows[:-1] if messages != written]
        if wrong:
            raise RuntimeError(f"batch {batch_id}: messages and written rows differ ({'; '.join(wrong)})")

    def read(self) -> DataFrame:
        """kind, messages, written, waiting_files, waiting_bytes, inserted_at, batch_id of all batches."""
        return self.spark.read.schema(stored_schema(COUNT_SCHEMA)).parquet(self.path)
