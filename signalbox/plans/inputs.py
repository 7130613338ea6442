"""Shared inputs of the catalog queries, derived from the provided tables.

Names follow the query contract: ``feed`` (messages), ``feed2`` (messages
with replayed copies), ``mv``/``cx`` (enriched facts of ``feed``),
``mv_rows2``/``cx_rows2`` (table rows of ``feed2``), ``mvd_raw``/``cxd_raw``
(deduplicated table rows, epoch-ms times), ``mvd``/``cxd`` (prepared for
reports), ``ab`` (anomalies), ``coords`` (station coordinates).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbox.operators.rollup import PARTIAL_SCHEMA
from signalbox.operators import dedup, transforms as tf
from signalbox.operators.anomaly import detect_anomalies
from signalbox.operators.joins import row_bound
from signalbox.plans._cache import LOCK, once
from signalbox.plans.landing import Landing, land, read_clean
from signalbox.schemas import CANCELLATION_TABLE_SCHEMA, MOVEMENT_TABLE_SCHEMA
from signalbox.sinks.writers import read_snapshot
from signalbox.sources import testdata
from signalbox.sources.dimensions import location_dim, station_coordinates


# Reference dimensions are static; like a long-running job, a session derives
# each one once, keeps it (memory, spilling to disk; lost blocks are rebuilt
# from lineage) and records its checked size.
_DIMENSIONS: dict[tuple[str, str, str], tuple[DataFrame, int]] = {}


def _dimension(spark: SparkSession, sf_dir: str, name: str, build) -> tuple[DataFrame, int]:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with LOCK:
        if key not in _DIMENSIONS:
            df = build().persist(StorageLevel.MEMORY_AND_DISK)
            _DIMENSIONS[key] = (df, row_bound(df))
        return _DIMENSIONS[key]


_INPUTS: dict[tuple[str, str], "Inputs"] = {}


class Inputs:
    """Lazily built input plans; one instance per (session, data folder)."""

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir)
        with LOCK:
            if key not in _INPUTS:
                obj = super().__new__(cls)
                obj.spark = spark
                obj.sf_dir = sf_dir
                _INPUTS[key] = obj
            return _INPUTS[key]

    def __init__(self, spark: SparkSession, sf_dir: str):
        pass

    @once
    def landed(self) -> Landing:
        return land(self.spark, self.sf_dir, self.dim, self.dim_rows)

    def _landed_feed(self) -> DataFrame:
        return self.spark.read.parquet(self.landed.feed_path)

    @once
    def feed(self) -> DataFrame:
        """Messages as landed (first delivery only)."""
        return self._landed_feed().filter(F.col("batch_id") == 0).select("header", "body")

    @once
    def feed2(self) -> DataFrame:
        """Messages as landed including replayed copies."""
        return self._landed_feed().select("header", "body")

    @once
    def _dim(self) -> tuple[DataFrame, int]:
        return _dimension(self.spark, self.sf_dir, "location",
                          lambda: location_dim(testdata.location_records(self.spark, self.sf_dir)))

    @property
    def dim(self) -> DataFrame:
        return self._dim[0]

    @property
    def dim_rows(self) -> int:
        """Checked size of the location dimension (bounded count)."""
        return self._dim[1]

    @once
    def _coords(self) -> tuple[DataFrame, int]:
        return _dimension(self.spark, self.sf_dir, "coordinates",
                          lambda: station_coordinates(testdata.coordinate_records(self.spark, self.sf_dir)))

    @property
    def coords(self) -> DataFrame:
        return self._coords[0]

    @property
    def coords_rows(self) -> int:
        return self._coords[1]

    def enriched_delay(self, feed: DataFrame) -> DataFrame:
        return tf.add_location_names(tf.calculate_delay(tf.extract_movements(feed)), self.dim, self.dim_rows)

    def enriched_cancellations(self, feed: DataFrame) -> DataFrame:
        return tf.add_location_names(tf.extract_cancellations(feed), self.dim, self.dim_rows)

    @once
    def mv(self) -> DataFrame:
        return self.enriched_delay(self.feed)

    @once
    def cx(self) -> DataFrame:
        return self.enriched_cancellations(self.feed)

    @once
    def mv_rows2(self) -> DataFrame:
        return tf.movement_rows(self.enriched_delay(self.feed2))

    @once
    def cx_rows2(self) -> DataFrame:
        return tf.cancellation_rows(self.enriched_cancellations(self.feed2))

    @once
    def mv_table(self) -> DataFrame:
        """Movement table as written by ingestion (all batches, replays included)."""
        return self.landed.sink.read_movements(self.spark)

    @once
    def cx_table(self) -> DataFrame:
        return self.landed.sink.read_cancellations(self.spark)

    def dedup_mv_table(self) -> DataFrame:
        """D-03 run on the movement table (epoch-ms times)."""
        return dedup.dedup_movements(self.mv_table).drop("inserted_at")

    def dedup_cx_table(self) -> DataFrame:
        """D-04 run on the cancellation table."""
        return dedup.dedup_cancellations(self.cx_table).drop("inserted_at")

    @once
    def mvd_raw(self) -> DataFrame:
        """Deduplicated movements as published by the refresh step."""
        return read_clean(self.spark, self.landed.clean_movements_path, MOVEMENT_TABLE_SCHEMA)

    @once
    def cxd_raw(self) -> DataFrame:
        """Deduplicated cancellations as published by the refresh step."""
        return read_clean(self.spark, self.landed.clean_cancellations_path, CANCELLATION_TABLE_SCHEMA)

    @staticmethod
    def prepare_mv(raw: DataFrame) -> DataFrame:
        return tf.with_delay_minutes(tf.with_event_time(raw, "actual_timestamp"))

    @staticmethod
    def prepare_cx(raw: DataFrame) -> DataFrame:
        return tf.with_event_time(raw, "canx_timestamp")

    @once
    def mvd(self) -> DataFrame:
        return self.prepare_mv(self.mvd_raw)

    @once
    def cxd(self) -> DataFrame:
        return self.prepare_cx(self.cxd_raw)

    @once
    def station_mvd(self) -> DataFrame:
        return tf.filter_station_rows(self.mvd)

    def detect(self) -> DataFrame:
        """X-04 run on the deduplicated facts.

        Station names and codes come from the location dimension, so its
        checked size bounds every per-station frame.
        """
        return detect_anomalies(self.mvd_raw, self.cxd_raw, station_bound=self.dim_rows)

    @once
    def partials(self) -> DataFrame:
        """10-minute partials as published by the refresh step."""
        return self.spark.read.schema(PARTIAL_SCHEMA).parquet(self.landed.rollup_path)

    @once
    def ab(self) -> DataFrame:
        """Anomaly table as published by the refresh step."""
        return read_snapshot(self.spark, self.landed.anomalies_path)
