"""Event time as UTC, whatever the session's time zone.

A cast between TIMESTAMP and TIMESTAMP_NTZ goes through the session zone, which shifts
events by hours and cannot write the hour that a daylight-saving change skips.  These
expressions work on the microseconds instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def instant(name: str) -> Column:
    """A TIMESTAMP_NTZ column that holds UTC wall time, as the TIMESTAMP it means."""
    seconds = f"cast(cast((`{name}` - {_EPOCH}) as interval second) as decimal(20, 6))"
    return F.expr(f"timestamp_micros(cast({seconds} * 1000000 as bigint))")


def wall(name: str) -> Column:
    """A TIMESTAMP column as its UTC wall time (TIMESTAMP_NTZ)."""
    return F.expr(f"{_EPOCH} + make_dt_interval(0, 0, 0, cast(unix_micros(`{name}`) as decimal(24, 6)) / 1000000)")


def day(name: str) -> Column:
    """The UTC date of a TIMESTAMP column."""
    return wall(name).cast("date")


def iso_text(name: str) -> Column:
    """A TIMESTAMP column as ISO text with microseconds, in UTC (``...T...Z``)."""
    seconds = F.translate(F.substring(wall(name).cast("string"), 1, 19), " ", "T")
    micros = F.lpad(F.pmod(F.unix_micros(F.col(name)), F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(seconds, F.lit("."), micros, F.lit("Z"))
