"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(ts: Column, ntz: bool = True) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ wall time read as UTC.

    Built from the date and the time-of-day fields, which for TIMESTAMP_NTZ
    involve no time zone, so the number is the same whatever
    ``spark.sql.session.timeZone`` is (casting to TIMESTAMP, or
    ``timestampdiff`` on TIMESTAMP, goes through the session zone and is off
    by the DST offset or on nonexistent local times). For a TIMESTAMP
    (instant) column pass ``ntz=False``."""
    if not ntz:
        return F.unix_micros(ts)
    day = F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000_000
    tod = (F.hour(ts).cast("bigint") * 3_600_000_000 + F.minute(ts).cast("bigint") * 60_000_000
           + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"))
    return day + tod


def ntz_from_micros(us: Column) -> Column:
    """TIMESTAMP_NTZ wall time (UTC) of epoch microseconds, zone-independent."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH_NTZ))

