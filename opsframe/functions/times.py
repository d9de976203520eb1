"""Time helpers that never depend on the session time zone.

Control-table timestamps are UTC wall-clock values (``timestamp_ntz``).
Casting them to ``timestamp`` would interpret them in the session zone (and
shift across daylight-saving changes), so epoch arithmetic is done on the
wall-clock values directly with ``timestamp_diff``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a UTC wall-clock (NTZ) value."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), _c(ts).cast("timestamp_ntz"))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 (floor), like ``unix_timestamp`` at UTC."""
    return F.floor(epoch_micros(ts) / F.lit(1_000_000)).cast("bigint")


def seconds_between(start, end) -> Column:
    """``floor(epoch(end)) - floor(epoch(start))`` in seconds."""
    return (epoch_seconds(end) - epoch_seconds(start)).cast("bigint")
