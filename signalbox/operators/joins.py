"""Joins against small frames, broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbox.constants import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS

# Per-value width estimates (Spark's default sizes for these types).
_WIDTH = {"string": 20, "bigint": 8, "double": 8, "int": 4, "date": 4, "timestamp": 8,
          "timestamp_ntz": 8, "boolean": 1}


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the schema (nested types count 64)."""
    return sum(_WIDTH.get(t, 64) for _, t in df.dtypes) + 8


def row_bound(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> int:
    """Row count of ``small``, or ``max_rows + 1`` if it is larger.

    Runs a bounded job (``limit(max_rows + 1)``), so the check never scans
    more than needed to decide.
    """
    return small.limit(max_rows + 1).count()


def join_small(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "left",
    max_rows: int = BROADCAST_MAX_ROWS,
    known_rows: int | None = None,
) -> DataFrame:
    """Join ``big`` with ``small``; broadcast ``small`` only if its size is proven.

    ``known_rows`` is an upper bound on the rows of ``small`` that the caller
    already established (for example, per-station statistics have at most
    one row per location record of a checked dimension); without it the size
    is measured. The estimated bytes (rows x schema row width) must also stay
    within ``BROADCAST_MAX_BYTES``. Beyond either bound the join falls back to
    a shuffle join, in which adaptive execution splits skewed keys of ``big``.
    """
    rows = known_rows if known_rows is not None else row_bound(small, max_rows)
    if rows <= max_rows and rows * row_width(small) <= BROADCAST_MAX_BYTES:
        small = F.broadcast(small)
    return big.join(small, on, how)
