"""Station outliers (X-02, A-14) from a state that is carried from batch to batch.

Whether a delay is an outlier depends on its station's whole history, so a
full run scans all movements. Here the history is replaced by

* moments per station (number, sum, sum of squares, as exact integers), which
  the moments of a batch's new rows are added to; and
* a tail: the rows of high delays, stored once per batch. A station's ``mark``
  is the delay from which on the tail holds *all* its rows.

A row is an outlier from mean + z deviations on. The mark lies one deviation
lower, so the rows between are at hand when the statistics move. Stations
that cannot be scored yet have no mark: the tail holds all their rows. If
the limit of a station falls below its mark after all, the rows between are
read from the clean table (the only scan of history; only the stations and
delays concerned) and the mark moves down. Moving a mark up costs nothing.

The outliers are those of a full run to the last digit, in whatever order the
rows came, since both use the same exact moments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox import constants as C
from signalbox.operators.anomaly import (
    SUM,
    score_outliers,
    station_delay_moments,
    stats_of_moments,
    timed_delays,
)
from signalbox.operators.joins import join_small
from signalbox.schemas import MOVEMENT_TABLE_SCHEMA
from signalbox.sinks.writers import BATCH_COLUMN, DATE_COLUMN
from signalbox.streaming.state import VersionedState

# Deviations between the limit of an outlier and the mark; a mark more than
# twice as far below is moved up.
MARGIN = 1.0
SLACK = 0.01

STATE_SCHEMA = T.StructType([
    T.StructField("local_name", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("total", T.DecimalType(38, 0)),
    T.StructField("squares", T.DecimalType(38, 0)),
    T.StructField("mark", T.DoubleType()),
])
TAIL_SCHEMA = T.StructType(MOVEMENT_TABLE_SCHEMA.fields + [T.StructField(BATCH_COLUMN, T.LongType())])
ROW = MOVEMENT_TABLE_SCHEMA.fieldNames()


class OutlierState:
    """Moments and tail of the clean movements that ``clean`` (an ``IncrementalClean``) keeps."""

    def __init__(self, spark: SparkSession, path: str, clean, station_bound: int | None = None,
                 z_threshold: float = C.Z_SCORE_THRESHOLD, min_samples: int = C.MIN_STATION_SAMPLES):
        self.spark = spark
        self.clean = clean
        self.station_bound = station_bound
        self.z_threshold = z_threshold
        self.min_samples = min_samples
        self.tail_path = f"{path.rstrip('/')}/_tail"
        self.state = VersionedState(spark, f"{path.rstrip('/')}/_stations", STATE_SCHEMA)
        #: Rows that the last call read: of the batches' own, of the history, of the tail.
        self.rows_read: dict[str, int] = {}

    def _counted(self, df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
        seen = Observation(name)
        return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

    def _merged(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Moments of both, the mark so far, and the limit from which on a delay is an outlier."""
        moments = (
            old.select("local_name", "n", "total", "squares", "mark", F.lit(True).alias("known"))
            .unionByName(new.select("*", F.lit(None).cast("double").alias("mark"), F.lit(False).alias("known")))
            .groupBy("local_name")
            .agg(
                F.sum("n").alias("n"), F.sum("total").cast(SUM).alias("total"), F.sum("squares").cast(SUM).alias("squares"),
                F.max("mark").alias("mark"), F.max("known").alias("known"),
            )
        )
        scored = (F.col("std") > 0) & (F.col("n") >= self.min_samples)
        return stats_of_moments(moments).withColumn(
            "limit", F.when(scored, F.col("mean") + self.z_threshold * F.col("std")))

    def fold(self, first: int, last: int) -> DataFrame:
        """Add the batches ``first`` to ``last`` to the state; all present outliers."""
        added, own = self._counted(self.clean.added("movements", first, last).select(*ROW), "added")
        # One row per station: the aggregate of the batches' rows is kept for the two uses below.
        stations = self._merged(self.state.before(first), station_delay_moments(added)).persist()
        try:
            near = F.col("mean") + (self.z_threshold - MARGIN) * F.col("std")
            far = F.col("mean") + (self.z_threshold - 2 * MARGIN) * F.col("std")
            # With a little slack, as limit and score are rounded separately.
            falls = F.col("limit") - SLACK * F.col("std") < F.col("mark")
            mark = (
                F.when(F.col("limit").isNull(), F.col("mark"))
                .when(F.col("mark").isNull() | falls | (F.col("mark") < far), near)
                .otherwise(F.col("mark"))
            )
            version = self.state.write(
                stations.select("local_name", "n", "total", "squares", mark.alias("mark")), last)
            fallen = stations.filter(falls).select("local_name", near.alias("from"), F.col("mark").alias("to"))
            self._store_tail(first, last, version, fallen)
        finally:
            stations.unpersist()
        self.rows_read = {"added": own.get["rows"], **self.rows_read}
        tail = self.spark.read.schema(TAIL_SCHEMA).parquet(self.tail_path).filter(F.col(BATCH_COLUMN) <= last)
        stats = stats_of_moments(version.drop("mark"))
        limits = stats.filter((F.col("std") > 0) & (F.col("n") >= self.min_samples)).select(
            "local_name", (F.col("mean") + (self.z_threshold - SLACK) * F.col("std")).alias("least"))
        # Rows of the tail are clean rows; one that was stored twice (a mark that rose and fell) counts once.
        near = join_small(tail.select(*ROW), limits, "local_name", "inner", known_rows=self.station_bound).filter(
            F.col("delay_seconds") >= F.col("least")).select(*ROW).distinct()
        return score_outliers(near, stats, self.z_threshold, self.min_samples, self.station_bound)

    def _store_tail(self, first: int, last: int, version: DataFrame, fallen: DataFrame) -> None:
        marks = version.select("local_name", "mark")
        rows = timed_delays(self.clean.added("movements", first, last).select(*ROW))
        high = join_small(rows, marks, "local_name", "inner", known_rows=self.station_bound).filter(
            F.col("mark").isNull() | (F.col("delay_seconds") >= F.col("mark"))).select(*ROW)
        self.rows_read = {"history": 0}
        lowered = fallen.count()
        seen = None
        if lowered:
            least = fallen.agg(F.min("from")).first()[0]  # reaches the scan as a filter on the delay
            before = self.clean.history("movements").filter(
                (F.col(BATCH_COLUMN) < first) & (F.col("delay_seconds") >= least)).drop(BATCH_COLUMN, DATE_COLUMN)
            before, seen = self._counted(before, "history")
            between = join_small(timed_delays(before), fallen, "local_name", "inner", known_rows=lowered).filter(
                (F.col("delay_seconds") >= F.col("from")) & (F.col("delay_seconds") < F.col("to")))
            high = high.unionByName(between.select(*ROW))
        (
            high.withColumn(BATCH_COLUMN, F.lit(last).cast("long")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(self.tail_path)
        )
        if seen is not None:
            self.rows_read["history"] = seen.get["rows"]
