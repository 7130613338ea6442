"""Stored layout of the fact tables (K-06): batch folders of closed days become one sorted set of files.

Every micro-batch leaves a folder per day it touches
(``event_date=<d>/batch_id=<n>``), so a long stream would leave folders without
end. ``FoldedTable.fold`` rewrites the folders of days that are over, up to a
batch that is surely finished, as files sorted by day and time below
``_folded/fold=<n>/event_date=<d>``. A log (``_folds``, one finished version a
fold) names the fold that holds each day and how far the folds reach, the day
``before`` and the batch ``through``. A row is read from the folds if the log
covers it, else from its batch folder, so

* readers see a fold as a whole or not at all: it counts from the moment its
  log version is finished, and a fold that failed halfway is never read;
* readers that started earlier go on with the batch folders, which stay until
  ``retire`` removes those that a fold of a given age covers;
* a late batch of a folded day is read from its own folder, and the next fold
  rewrites that day.

Folded rows keep their batch number and insert time. Rows without a time are a
day of their own, which every fold may take up. The log has one row per day.
"""

from __future__ import annotations

import datetime
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox.sinks.writers import BATCH_COLUMN, DATE_COLUMN, _hadoop_fs, stored_schema
from signalbox.streaming.state import VersionedState

FOLD_COLUMN = "fold"
LOG_SCHEMA = T.StructType([
    T.StructField(DATE_COLUMN, T.DateType()), T.StructField(FOLD_COLUMN, T.LongType()),
    T.StructField("before", T.DateType()), T.StructField("through", T.LongType()),
])
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _covered(before: datetime.date, through: int) -> Column:
    """Rows of closed days up to a batch; on the partition columns, so it prunes folders."""
    day = F.col(DATE_COLUMN)
    return (day.isNull() | (day < F.lit(before))) & (F.col(BATCH_COLUMN) <= F.lit(through))


class FoldedTable:
    """A dated fact table (``event_date``, ``batch_id``) with its folds."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.folded = f"{self.path}/_folded"
        self.stored = stored_schema(schema, dated=True)
        self.log = VersionedState(spark, f"{self.path}/_folds", LOG_SCHEMA)

    def _entries(self, version: int | None = None) -> list:
        """The log's rows, one per folded day; none before the first fold."""
        if version is None:
            versions = self.log.versions()
            if not versions:
                return []
            version = versions[-1]
        return self.log.read(version).collect()

    def _loose(self) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(self.path)

    def _folds(self, entries: list) -> DataFrame:
        """Folded rows of the days that ``entries`` name."""
        leaves = [f"{self.folded}/{FOLD_COLUMN}={e[FOLD_COLUMN]}/{DATE_COLUMN}={e[DATE_COLUMN] or NO_DATE}"
                  for e in entries]
        schema = T.StructType([*self.stored.fields, T.StructField(FOLD_COLUMN, T.LongType())])
        rows = self.spark.read.option("basePath", self.folded).schema(schema).parquet(*leaves)
        return rows.select(*self.stored.fieldNames())

    def read(self, since: int | None = None) -> DataFrame:
        """All rows, or those of the batches from ``since`` on, which leave out folds that end before it."""
        entries = self._entries()
        if not entries:
            rows = self._loose()
        else:
            rows = self._loose().filter(~_covered(entries[0].before, entries[0].through))
            if since is None or since <= entries[0].through:
                rows = rows.unionByName(self._folds(entries))
        return rows if since is None else rows.filter(F.col(BATCH_COLUMN) >= since)

    def fold(self, before: datetime.date, through: int, time_col: str) -> list[datetime.date | None]:
        """Fold the batches up to ``through`` of all days before ``before``; returns the days written.

        ``through`` must be a batch that no restart can deliver again, nor any
        step still has to read alone. Neither bound may fall below that of the
        last fold.
        """
        entries = self._entries()
        fresh = self._loose().filter(_covered(before, through))
        if entries:
            last = entries[0]
            if before < last.before or through < last.through:
                raise ValueError(f"an earlier fold reaches day {last.before} and batch {last.through}")
            fresh = fresh.filter(~_covered(last.before, last.through))
        days = [r[0] for r in fresh.select(DATE_COLUMN).distinct().collect()]
        if not days:
            return []
        versions = self.log.versions()
        number = versions[-1] + 1 if versions else 0
        again = [e for e in entries if e[DATE_COLUMN] in days]
        rows = fresh.unionByName(self._folds(again)) if again else fresh
        order = [DATE_COLUMN, time_col, *[c for c in ("train_id", "loc_stanox") if c in rows.columns], BATCH_COLUMN]
        (
            rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .write.mode("overwrite").partitionBy(DATE_COLUMN).parquet(f"{self.folded}/{FOLD_COLUMN}={number}")
        )
        holds = {e[DATE_COLUMN]: e[FOLD_COLUMN] for e in entries} | dict.fromkeys(days, number)
        self.log.write(self.spark.createDataFrame(
            [(day, fold, before, through) for day, fold in holds.items()], LOG_SCHEMA).coalesce(1), number)
        return sorted(days, key=lambda d: (d is not None, d))

    def retire(self, older_than_seconds: float) -> list[str]:
        """Remove the batch folders and folds that a fold of at least this age has replaced.

        The age must exceed the longest run of a reader. A reader that lists
        the table at the very moment of removal may have to list it again.
        """
        fs, _ = _hadoop_fs(self.spark, self.path)
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        limit = (time.time() - older_than_seconds) * 1000
        versions = self.log.versions()
        aged = [v for v in versions
                if fs.getFileStatus(hpath(f"{self.log.path}/v={v:015d}/_SUCCESS")).getModificationTime() <= limit]
        if not aged:
            return []
        bounds = self._entries(aged[-1])[0]
        named = {(e[FOLD_COLUMN], str(e[DATE_COLUMN] or NO_DATE)) for v in versions if v >= aged[-1] for e in self._entries(v)}

        def folders(path: str, column: str) -> list[tuple[str, str]]:
            found = [s.getPath() for s in fs.listStatus(hpath(path)) if s.isDirectory()]
            return [(p.getName().split("=", 1)[1], p.toString()) for p in found if p.getName().startswith(f"{column}=")]

        old = []
        for day, place in folders(self.path, DATE_COLUMN):
            if day == NO_DATE or day < str(bounds.before):
                batches = folders(place, BATCH_COLUMN)
                gone = [p for n, p in batches if int(n) <= bounds.through]
                old += [place] if gone and len(gone) == len(batches) else gone
        for fold, place in folders(self.folded, FOLD_COLUMN):
            if int(fold) <= aged[-1]:
                old += [p for day, p in folders(place, DATE_COLUMN) if (int(fold), day) not in named]
        for folder in old:
            fs.delete(hpath(folder), True)
        return old
