"""Small tables that a step carries from batch to batch, one complete version per batch.

A step that works on the batches ``first`` to ``last`` reads the newest
version before ``first`` and writes version ``last``. Working on a range again
(after a failure) therefore starts from the same rows and replaces its own
version, so what is added up is never added twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from signalbox.sinks.writers import _hadoop_fs

KEPT_VERSIONS = 3


class VersionedState:
    """Versions of one table under ``path``; a version counts once it is finished."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version:015d}"

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        fs, root = _hadoop_fs(self.spark, self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        numbers = sorted(int(n.removeprefix("v=")) for n in names if n.startswith("v="))
        return [n for n in numbers if fs.exists(_hadoop_fs(self.spark, f"{self._folder(n)}/_SUCCESS")[1])]

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def before(self, batch_id: int) -> DataFrame:
        """The newest version older than ``batch_id``; an empty table before the first."""
        older = [v for v in self.versions() if v < batch_id]
        return self.read(older[-1]) if older else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Store ``df`` as version ``batch_id`` and read it back; old versions go."""
        df.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._folder(batch_id))
        for old in [v for v in self.versions() if v < batch_id][: -(KEPT_VERSIONS - 1) or None]:
            fs, folder = _hadoop_fs(self.spark, self._folder(old))
            fs.delete(folder, True)
        return self.read(batch_id)
