"""Steps that run after a micro-batch was written, and what they have finished.

A step keeps the largest batch id it has finished in an empty marker file
under ``<path>/_progress``. Each call works on every batch after that one up
to the current batch, so a batch whose step failed is taken up by the next
call instead of being forgotten. The marker is written after the work, so a
step must give the same result when a range of batches is worked on again.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from signalbox.sinks.writers import BATCH_COLUMN, _hadoop_fs


class StepProgress:
    """The largest finished batch id, kept beside a step's table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = f"{path.rstrip('/')}/_progress"

    def _marks(self) -> list[int]:
        fs, root = _hadoop_fs(self.spark, self.path)
        if not fs.exists(root):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(root))

    def done(self) -> int:
        """Largest finished batch id; -1 before the first."""
        marks = self._marks()
        return marks[-1] if marks else -1

    def mark(self, batch_id: int) -> None:
        """Record ``batch_id`` as finished, then drop the older markers."""
        fs, marker = _hadoop_fs(self.spark, f"{self.path}/{batch_id:015d}")
        fs.create(marker, True).close()
        for old in self._marks()[:-1]:
            fs.delete(_hadoop_fs(self.spark, f"{self.path}/{old:015d}")[1], False)


class BatchStep:
    """An ``after_write`` step that leaves no batch out; subclasses give ``process``.

    ``then`` is a following step; it keeps its own progress and is called with
    the same batch id once this step has finished.
    """

    READERS = ("read_movements_with_batch", "read_cancellations_with_batch")

    def __init__(self, spark: SparkSession, sink, path: str, then=None):
        missing = [r for r in self.READERS if not hasattr(sink, r)]
        if missing:
            raise TypeError(
                f"{type(sink).__name__} cannot read single batches back ({', '.join(missing)}); "
                f"{type(self).__name__} needs a sink that can, such as ParquetFactSink")
        self.spark = spark
        self.sink = sink
        self.then = then
        self.progress = StepProgress(spark, path)
        self.unfinished: int | None = None

    def process(self, first: int, last: int) -> None:
        """Work on the batches ``first`` to ``last``, both included."""
        raise NotImplementedError

    def __call__(self, batch_id: int) -> None:
        self.unfinished = batch_id
        first = self.progress.done() + 1
        if batch_id < first - 1:
            raise ValueError(
                f"batch {batch_id} comes after batch {first - 1} was finished: batch ids must go on where an "
                "earlier run ended (start_feed_stream numbers them so)")
        if first <= batch_id:
            self.process(first, batch_id)
            self.progress.mark(batch_id)
        if self.then is not None:
            self.then(batch_id)
        self.unfinished = None

    def catch_up(self) -> None:
        """Finish what the last call left open; raises if that fails again.

        For the end of a run, when no later batch would take it up.
        """
        if self.unfinished is not None:
            self(self.unfinished)


def in_batches(first: int, last: int) -> Column:
    return F.col(BATCH_COLUMN).between(first, last)
