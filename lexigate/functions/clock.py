"""Wall-clock arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_micros(ts: Column) -> Column:
    """Microseconds from 1970-01-01 00:00 to the wall-clock reading of a timestamp.

    For a zone-less timestamp this is the same number in every session time zone.
    """
    seconds = F.date_part(F.lit("SECOND"), ts)
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000_000
        + F.hour(ts).cast("bigint") * 3_600_000_000
        + F.minute(ts).cast("bigint") * 60_000_000
        + (seconds * F.lit(1_000_000)).cast("bigint")
    )


def as_instant(ts: Column) -> Column:
    """A zone-less timestamp read as UTC: an event time a watermark accepts."""
    return F.timestamp_micros(wall_micros(ts))


def utc_day(instant: Column) -> Column:
    """UTC calendar day of an instant."""
    days = F.floor(F.unix_micros(instant) / F.lit(86_400_000_000))
    return F.date_from_unix_date(days.cast("int"))
