"""Feed message sources (S-01 ... S-04, S-11).

Files hold pretty-printed JSON: one message object or an array of message
objects per file. The schema is always fixed (``FEED_SCHEMA``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from signalbox.constants import MAX_FILES_PER_TRIGGER
from signalbox.schemas import CORRUPT_COLUMN, FEED_SCHEMA

JSON_GLOB = "*.json"


def read_feed(spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    """S-01: batch read of message files (``*.json`` only; stray files are ignored).

    A top-level array yields one row per element. Each multi-line file is one
    task, so landed feeds should be compacted to Parquet for large scans.
    """
    return (
        spark.read.option("multiLine", "true")
        .option("pathGlobFilter", JSON_GLOB)
        .schema(schema)
        .json(path)
    )


def admitted(reader: DataStreamReader, max_files: int | None, max_bytes: int | None, archive: str | None) -> DataStreamReader:
    """``reader`` of a file stream, bounded per trigger by bytes if given, else by files.

    A file larger than ``max_bytes`` is a batch of its own. ``archive``: a
    folder outside the landing folder, on the same file system, to which the
    files of committed batches move; Spark moves them in the background once
    the next batch is planned, so the files of the last one stay.
    """
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes))
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


def read_feed_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    schema: T.StructType = FEED_SCHEMA,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """S-02: file stream over the landing folder, rate limited per trigger by files, or by bytes if given.

    Landing contract: writers create files under a temporary name and rename
    them into place, so a trigger never sees a half-written file.
    """
    return (
        admitted(spark.readStream, max_files_per_trigger, max_bytes, archive).option("multiLine", "true")
        .option("pathGlobFilter", JSON_GLOB)
        .schema(schema)
        .json(path)
    )


def read_feed_text(spark: SparkSession, path: str) -> DataFrame:
    """Landed message files as whole-file text (one row per file)."""
    return spark.read.text(path, wholetext=True)


def read_feed_text_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    max_bytes: int | None = None, archive: str | None = None,
) -> DataFrame:
    """File stream of whole message files as text, with their path (``value``, ``file_path``).

    For feeds whose corrupt files are to be kept (``quarantine_rows``). The
    landing contract of ``read_feed_stream`` holds here too.
    """
    return (
        admitted(spark.readStream, max_files_per_trigger, max_bytes, archive)
        .option("pathGlobFilter", JSON_GLOB)
        .text(path, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("file_path"))
    )


def read_message_lines(spark: SparkSession, paths) -> DataFrame:
    """Message text stored one message per line (``value`` column)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths)


def parse_feed_text(df: DataFrame, text_col: str = "value", schema: T.StructType = FEED_SCHEMA) -> DataFrame:
    """Parse message text into ``header``/``body`` plus a corrupt-text column.

    A text holding a JSON array gives one row per element; a text that is not
    valid JSON gives one row with null ``header``/``body`` and the original
    text in ``_corrupt_record``. Other input columns are kept.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    text = F.col(text_col)
    is_array = F.startswith(F.ltrim(text), F.lit("["))
    as_array = F.from_json(text, T.ArrayType(schema), opts)
    as_object = F.from_json(text, with_corrupt, opts)
    bad = F.struct(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
        text.alias(CORRUPT_COLUMN),
    )
    elements = F.when(
        is_array,
        F.coalesce(
            F.transform(as_array, lambda m: F.struct(*[m[f.name].alias(f.name) for f in schema.fields],
                                                       F.lit(None).cast("string").alias(CORRUPT_COLUMN))),
            F.array(bad),
        ),
    ).otherwise(F.array(F.coalesce(as_object, bad)))
    others = [c for c in df.columns if c != text_col]
    return df.select(*others, F.explode(elements).alias("__m")).select(
        *others, "__m.header", "__m.body", f"__m.{CORRUPT_COLUMN}"
    )


def classify_feed_text(df: DataFrame, text_col: str = "value") -> DataFrame:
    """S-11: parsed messages with ``status`` = ``ok`` or ``corrupt``."""
    parsed = parse_feed_text(df, text_col)
    return parsed.withColumn(
        "status", F.when(F.col(CORRUPT_COLUMN).isNull(), F.lit("ok")).otherwise(F.lit("corrupt"))
    )


def quarantine_split(df: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """S-11: (good messages with ``header``/``body``, corrupt texts)."""
    classified = classify_feed_text(df, text_col)
    good = classified.filter(F.col("status") == "ok").select("header", "body")
    bad = classified.filter(F.col("status") == "corrupt").select(
        F.col(CORRUPT_COLUMN).alias("raw_text")
    )
    return good, bad


def quarantine_rows(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S-11 on whole texts with their path: (messages, corrupt texts as ``file_path``, ``raw_text``).

    A text that is blank, not JSON, or JSON of another shape (a number, a
    string) is corrupt. An array with an element that is no object is corrupt
    as a whole. Spark's readers leave out files of no bytes; there is nothing
    in them to keep.
    """
    classified = classify_feed_text(texts)
    good = classified.filter(F.col("status") == "ok").select("header", "body")
    bad = classified.filter(F.col("status") == "corrupt").select("file_path", F.col(CORRUPT_COLUMN).alias("raw_text"))
    return good, bad


def quarantine_counts(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Number of good and corrupt messages."""
    return classify_feed_text(df, text_col).groupBy("status").agg(F.count(F.lit(1)).alias("count"))


def compact_feed(spark: SparkSession, path: str, out: str, mode: str = "append") -> None:
    """Rewrite landed message files (``*.json``) as nested Parquet.

    Multi-line JSON cannot be split, so every scan of the raw files is one
    task per file; the compacted table splits by row group, keeps the nested
    ``header``/``body`` layout (so scans prune to the needed leaves) and is
    partitioned by message kind (``msg_kind``), so the extractors read only
    their kind. Read it back with ``read_compacted_feed``.
    """
    feed = read_feed(spark, path)
    (
        feed.withColumn("msg_kind", F.coalesce(F.col("header.msg_type"), F.lit("none")))
        .write.mode(mode)
        .partitionBy("msg_kind")
        .parquet(out)
    )


def read_compacted_feed(spark: SparkSession, path: str, kinds: list[str] | None = None) -> DataFrame:
    """Compacted messages (``header``/``body``), optionally only some kinds."""
    schema = T.StructType(FEED_SCHEMA.fields + [T.StructField("msg_kind", T.StringType())])
    df = spark.read.schema(schema).parquet(path)
    if kinds:
        df = df.filter(F.col("msg_kind").isin(kinds))
    return df.select("header", "body")
