"""Column-level helpers (built-in Spark expressions only, no Python UDFs)."""

from signalbox.functions.columns import *  # noqa: F401,F403
