"""Reference dimensions: locations (S-05) and station coordinates (S-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbox.functions.columns import has_text, safe_double
from signalbox.operators.dedup import keep_first
from signalbox.schemas import COORDINATE_RECORD_SCHEMA, COORDINATE_SCHEMA, CORPUS_SCHEMA


def read_location_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw location records from the reference file (one JSON object with an array)."""
    raw = spark.read.option("multiLine", "true").schema(CORPUS_SCHEMA).json(path)
    return raw.select(F.explode("TIPLOCDATA").alias("loc")).select("loc.*")


def location_dim(records: DataFrame) -> DataFrame:
    """S-05: trimmed location dimension with exactly one row per ``stanox``.

    Blank or null codes are dropped. Among rows sharing a code, one with a
    station code (``alpha3``) wins; remaining ties go to the smallest
    ``tiploc``, ``alpha3``, ``local_name``, ``local_name_short``.
    """
    trimmed = records.select(
        F.trim(F.col("STANOX")).alias("stanox"),
        F.trim(F.col("TIPLOC")).alias("tiploc"),
        F.trim(F.col("`3ALPHA`")).alias("alpha3"),
        F.trim(F.col("NLCDESC")).alias("local_name"),
        F.trim(F.col("NLCDESC16")).alias("local_name_short"),
    ).filter(has_text("stanox"))
    no_alpha3 = F.when(has_text("alpha3"), F.lit(0)).otherwise(F.lit(1))
    return keep_first(trimmed, ["stanox"], [no_alpha3])


def load_corpus(spark: SparkSession, path: str) -> DataFrame:
    """S-05 reader + cleaning."""
    return location_dim(read_location_records(spark, path))


def read_coordinate_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw coordinate records with their position in the file (``record_no``)."""
    raw = spark.read.option("multiLine", "true").schema(COORDINATE_RECORD_SCHEMA).json(path)
    return raw.withColumn("record_no", F.monotonically_increasing_id())


def station_coordinates(records: DataFrame) -> DataFrame:
    """S-06: one coordinate row per station code.

    Accepts the key as ``3alpha`` or ``alpha3``; latitude/longitude are coerced
    to numbers (bad -> null); rows without key or coordinates are dropped; the
    first remaining record per station (by ``record_no``) is kept.
    """
    cols = records.columns
    if "3alpha" in cols and "alpha3" in cols:
        key = F.coalesce(F.col("alpha3"), F.col("`3alpha`"))
    elif "3alpha" in cols:
        key = F.col("`3alpha`")
    else:
        key = F.col("alpha3")
    order = F.col("record_no") if "record_no" in cols else F.lit(0)
    clean = records.select(
        key.alias("alpha3"),
        F.col("station_name").cast("string").alias("station_name"),
        safe_double(F.col("latitude")).alias("latitude"),
        safe_double(F.col("longitude")).alias("longitude"),
        order.alias("record_no"),
    ).dropna(subset=["alpha3", "latitude", "longitude"])
    first = keep_first(clean, ["alpha3"], [F.col("record_no")])
    return first.select(*COORDINATE_SCHEMA.fieldNames())


def load_station_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """S-06 reader; a missing file gives an empty frame with the full schema."""
    try:
        return station_coordinates(read_coordinate_records(spark, path))
    except Exception as exc:  # missing path
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], COORDINATE_SCHEMA)
        raise
