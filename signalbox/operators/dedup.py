"""Deterministic deduplication (D-01 ... D-07).

``keep_first`` keeps one row per key: the row that is smallest by the given
order columns and then by all remaining columns. It is an aggregate
(``min`` over a struct), not a window: Spark combines copies map-side before
the shuffle, so a key with a huge number of copies never lands in one task as
a whole. Null key parts compare equal; nulls sort first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIRST = "__first"


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
) -> DataFrame:
    """One row per ``keys``; ties broken by ``order`` then the other columns."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    packed = F.struct(
        *[o.alias(f"__o{i}") for i, o in enumerate(order)],
        *[F.col(f"`{c}`").alias(c) for c in rest],
    )
    kept = df.groupBy(*keys).agg(F.min(packed).alias(_FIRST))
    return kept.select(
        *[F.col(f"`{c}`") if c in keys else F.col(f"{_FIRST}.`{c}`").alias(c) for c in df.columns]
    )


def _insert_order(df: DataFrame) -> list[Column]:
    """Earlier inserts win when the table records its insert time."""
    return [F.col("inserted_at")] if "inserted_at" in df.columns else []


# Write-time keys (one micro-batch).
MOVEMENT_WRITE_KEY = ["train_id", "loc_stanox", "event_type", "planned_timestamp", "actual_timestamp"]
CANCELLATION_WRITE_KEY = ["train_id", "loc_stanox", "canx_timestamp", "canx_type"]

# Read-time keys (whole table).
MOVEMENT_READ_KEY = MOVEMENT_WRITE_KEY + ["variation_status", "delay_seconds"]
CANCELLATION_READ_KEY = [
    "train_id", "loc_stanox", "tiploc", "canx_timestamp", "canx_reason_code", "canx_type",
]
ANOMALY_KEY = [
    "event_source", "train_id", "loc_stanox", "local_name", "event_type",
    "event_timestamp", "anomaly_type",
]


def _keyed(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """``keep_first`` on a complete key; a missing key column is an error."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns missing from the table: {', '.join(missing)}")
    return keep_first(df, keys, order)


def dedup_movements_on_write(df: DataFrame) -> DataFrame:
    """D-01."""
    return _keyed(df, MOVEMENT_WRITE_KEY)


def dedup_cancellations_on_write(df: DataFrame) -> DataFrame:
    """D-02."""
    return _keyed(df, CANCELLATION_WRITE_KEY)


def dedup_movements(df: DataFrame) -> DataFrame:
    """D-03: read-time movement dedup (drops cross-batch replays)."""
    return _keyed(df, MOVEMENT_READ_KEY, _insert_order(df))


def dedup_cancellations(df: DataFrame) -> DataFrame:
    """D-04."""
    return _keyed(df, CANCELLATION_READ_KEY, _insert_order(df))


def dedup_anomalies(df: DataFrame) -> DataFrame:
    """D-05."""
    return _keyed(df, ANOMALY_KEY, _insert_order(df))
