"""Scalar column expressions shared by the operators.

All helpers return ``Column`` objects made of built-in functions, so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalbox import constants as C

__all__ = [
    "epoch_ntz",
    "safe_long",
    "safe_int",
    "safe_double",
    "epoch_ms_to_ts",
    "ts_to_epoch_ms",
    "to_ts_ntz",
    "has_text",
    "is_late",
    "is_late_ci",
    "or_unknown",
    "anomaly_label",
    "clip",
    "marker_size",
    "delay_color",
    "abnormal_color",
    "station_tooltip",
    "bucket_start",
]

# Epoch as a zone-less timestamp. Conversions assume the session time zone is
# UTC (a required setting, see ``signalbox.session``).
def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")

# Largest epoch milliseconds mapped to a timestamp (end of year 9999); larger
# magnitudes are treated as bad values (null), not errors.
_MAX_EPOCH_MS = 253_402_300_799_999


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_long(c) -> Column:
    """Text or number to 64-bit int; bad or fractional text gives null."""
    return _c(c).try_cast("long")


def safe_int(c) -> Column:
    return _c(c).try_cast("int")


def safe_double(c) -> Column:
    """Numeric coercion; non-numeric gives null."""
    return _c(c).try_cast("double")


def epoch_ms_to_ts(c) -> Column:
    """Epoch milliseconds (number or text) to a ``timestamp_ntz``; bad -> null."""
    ms = safe_long(c)
    return F.when(
        ms.between(-_MAX_EPOCH_MS, _MAX_EPOCH_MS),
        F.timestamp_add("MILLISECOND", ms, epoch_ntz()),
    )


def ts_to_epoch_ms(c) -> Column:
    """``timestamp_ntz`` to epoch milliseconds (truncating micro-seconds)."""
    return F.timestamp_diff("MILLISECOND", epoch_ntz(), _c(c))


def to_ts_ntz(c, data_type: str) -> Column:
    """Any time-like value to ``timestamp_ntz``; unparsable text gives null."""
    col = _c(c)
    if data_type == "string":
        return col.try_cast("timestamp_ntz")
    if data_type in ("bigint", "int"):
        return epoch_ms_to_ts(col)
    return col.cast("timestamp_ntz")


def has_text(c) -> Column:
    """Non-null and non-empty."""
    col = _c(c)
    return col.isNotNull() & (col != F.lit(""))


def is_late(c) -> Column:
    """Exact status match (batch statistics)."""
    return _c(c) == F.lit(C.LATE_STATUS)


def is_late_ci(c) -> Column:
    """Case-insensitive status match; null is not late."""
    return F.coalesce(F.lower(_c(c)) == F.lit(C.LATE_STATUS.lower()), F.lit(False))


def or_unknown(c) -> Column:
    return F.coalesce(_c(c), F.lit(C.UNKNOWN_LABEL))


def anomaly_label(c) -> Column:
    """Anomaly code -> display label; unknown codes stay as they are."""
    code = or_unknown(c)
    expr = None
    for key, label in C.ANOMALY_TYPE_LABELS.items():
        expr = (F.when(code == key, label) if expr is None else expr.when(code == key, label))
    return expr.otherwise(code)


def clip(c, low, high) -> Column:
    return F.least(F.greatest(_c(c), F.lit(low)), F.lit(high))


def marker_size(c, bounds, scale) -> Column:
    low, high = bounds
    return F.sqrt(clip(_c(c).cast("double"), float(low), float(high))) * F.lit(float(scale))


def delay_color(avg_delay_minutes) -> Column:
    """RGBA list: green-ish for no delay, red-ish at the clip limit."""
    d = clip(_c(avg_delay_minutes), 0.0, float(C.DELAY_COLOR_CLIP_MINUTES))
    frac = d / F.lit(float(C.DELAY_COLOR_CLIP_MINUTES))
    r0, g0, b0, a0 = C.DELAY_COLOR_BASE
    return F.array(
        (F.lit(r0) + F.floor(frac * C.DELAY_COLOR_RED_SPAN).cast("int")).cast("int"),
        (F.lit(g0) - F.floor(frac * C.DELAY_COLOR_GREEN_SPAN).cast("int")).cast("int"),
        F.lit(b0),
        F.lit(a0),
    )


def abnormal_color(abnormal_count) -> Column:
    on = F.array(*[F.lit(v) for v in C.ABNORMAL_COLOR])
    off = F.array(*[F.lit(v) for v in C.NO_ABNORMAL_COLOR])
    return F.when(_c(abnormal_count) > 0, on).otherwise(off)


def station_tooltip(name, alpha3, events, avg_delay, large, abnormal) -> Column:
    """Six newline-separated parts; the name falls back to the station code."""
    return F.concat(
        F.coalesce(_c(name), _c(alpha3)),
        F.lit("\nAlpha3: "), _c(alpha3),
        F.lit("\nEvents: "), _c(events).cast("string"),
        F.lit("\nAverage: "), F.bround(_c(avg_delay), 2).cast("string"), F.lit(" min"),
        F.lit("\nLarge delays: "), _c(large).cast("string"),
        F.lit("\nAbnormal events: "), _c(abnormal).cast("string"),
    )


def bucket_start(ts, duration: str) -> Column:
    """Start of the epoch-aligned tumbling bucket holding ``ts``."""
    return F.window(_c(ts), duration).start
