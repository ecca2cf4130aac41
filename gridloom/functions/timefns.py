"""Time expressions.

Timestamps are naive local times (the series carry no zone); rounding works
on the naive value, so the session zone never shifts a label.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

_UNIT_MICROS = {
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}
_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UTC+00:00"}


def _session_is_utc() -> bool:
    spark = SparkSession.getActiveSession()
    # (no default argument: Spark validates a default against the zone rules)
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in _UTC_NAMES


def _as(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _round(unit: str, ts: Column, dtype: DataType | None, up: bool) -> Column:
    """Floor or ceiling of the naive value.

    Every unit divides the day, so the label is the value plus (or minus) what
    its time of day lacks to (or has beyond) a multiple of the unit.  In a UTC
    session that is integer arithmetic on the microseconds; in another zone
    the same arithmetic runs on the fields of the naive value
    (``timestamp_ntz``), so no zone rule ever moves a label."""
    step = F.lit(_UNIT_MICROS[unit])
    if _session_is_utc():
        micros = F.unix_micros(ts.cast("timestamp"))
        out = F.timestamp_micros(micros + F.pmod(-micros, step) if up else micros - F.pmod(micros, step))
    else:
        # fields and intervals of a timestamp_ntz know no zone rules
        naive = ts.cast("timestamp_ntz")
        seconds = F.hour(naive) * 3600 + F.minute(naive) * 60 + F.extract(F.lit("SECOND"), naive)
        unit_s = F.lit(_UNIT_MICROS[unit] // 1_000_000)
        zero = F.lit(0)
        out = (naive + F.make_dt_interval(zero, zero, zero, F.pmod(-seconds, unit_s)) if up
               else naive - F.make_dt_interval(zero, zero, zero, F.pmod(seconds, unit_s)))
    return out.cast("timestamp_ntz" if isinstance(dtype, TimestampNTZType) else "timestamp")


def ceil_to(unit: str, ts: Column | str, dtype: DataType | None = None) -> Column:
    """Ceiling of ``ts`` to ``unit`` ("hour-ending" labels) on the naive
    local value, whatever the session zone.

    00:15, 00:30, 00:45 and 01:00 all map to 01:00; exact boundaries stay;
    the last quarter-hours of a year map to the next January 1st.
    """
    return _round(unit, _as(ts), dtype, up=True)


def trunc_to(unit: str, ts: Column | str, dtype: DataType | None = None) -> Column:
    """Floor of ``ts`` to ``unit`` (hour-beginning labels)."""
    return _round(unit, _as(ts), dtype, up=False)


def parse_timestamp(text: Column | str, fmt: str | None = None) -> Column:
    """Text -> timestamp; unparseable text gives null instead of an error."""
    c = _as(text)
    if fmt is None:
        return F.try_to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt))
