"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbox.session import scratch_path

# A frame is broadcast only when its measured rows and bytes are within these
# bounds; beyond them the same join runs as a shuffle join.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back (cuts the lineage)."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any letter case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value: measured for texts and arrays, a word for any other."""
    if isinstance(kind, T.StringType | T.BinaryType):
        size = F.octet_length(value).cast("long")
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(value, F.lit(0).cast("long"), lambda n, x: n + _value_bytes(x, kind.elementType))
    elif isinstance(kind, T.StructType):
        size = sum((_value_bytes(value[f.name], f.dataType) for f in kind), F.lit(0).cast("long"))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size, F.lit(0)) + 8


def rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    size = sum((_value_bytes(col(f.name), f.dataType) for f in df.schema), F.lit(0).cast("long"))
    rows, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows, total


def sized_broadcast(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` bytes."""
    rows, total = rows_and_bytes(df)
    return F.broadcast(df) if rows <= BROADCAST_ROWS and total <= BROADCAST_BYTES else df


def utf8(column: str | Column) -> Column:
    """The UTF-8 bytes of a text column (null: empty)."""
    return F.coalesce((col(column) if isinstance(column, str) else column).cast("binary"), F.lit(b""))


_WORKER_CACHES: dict[str, object] = {}


def worker_cache(name: str, make: Callable[[], object]):
    """An object that a Python worker keeps from task to task; another name frees it.

    Workers outlive a query, so only the running operator's cache stays in memory.
    """
    if name not in _WORKER_CACHES:
        _WORKER_CACHES.clear()
        _WORKER_CACHES[name] = make()
    return _WORKER_CACHES[name]


def give_back() -> None:
    """Return freed memory of this Python worker to the system.

    Workers outlive their tasks; what Arrow's pool and the allocator keep for
    reuse would count against the executor while other stages run.
    """
    pa.default_memory_pool().release_unused()
    try:
        import ctypes

        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # an allocator without it
        pass


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts go to Python in batches of at most ``rows``, which bounds the workers' memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` for functions that turn one batch into columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)
