"""Time differences that do not depend on the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000
EPOCH = "1970-01-01"


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from start to end; NULL when either is NULL."""
    # Through the interval: timestamps without zone are never placed in a zone.
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def micros_of(moment: Column) -> Column:
    """Microseconds since 1970."""
    return micros_between(F.lit(EPOCH).cast("timestamp_ntz"), moment)


def start_of_slice(micros: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``micros``; whole numbers throughout."""
    return micros - F.pmod(micros, F.lit(width))
