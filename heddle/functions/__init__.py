"""Column functions that fix the places where Spark's result follows the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(name: str, ts: Column) -> Column:
    return F.extract(F.lit(name), ts)


def _seconds(seconds: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def micros_ntz(ts: Column) -> Column:
    """Microseconds of a zone-free timestamp since 1970, as if its clock showed UTC. Null gives null."""
    seconds = F.unix_date(ts.cast("date")).cast("long") * 86_400 + _part("HOUR", ts) * 3_600 + _part("MINUTE", ts) * 60
    return seconds * 1_000_000 + (_part("SECOND", ts) * 1_000_000).cast("long")


def ntz_of_micros(micros: Column) -> Column:
    """The zone-free timestamp so many microseconds after 1970. Null gives null."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + _seconds(micros.cast("decimal(20,0)") / 1_000_000)


def trunc_ntz(unit: str, ts: Column) -> Column:
    """A zone-free timestamp cut to its year, quarter, month, week, day, hour, minute or second, zone-free again. Null gives null.

    date_trunc() would go through the session's zone and its gaps.
    """
    unit = unit.lower()
    second = _part("SECOND", ts)
    rest = {"second": second % 1, "minute": second, "hour": second + _part("MINUTE", ts) * 60}
    if unit in rest:
        return ts - _seconds(rest[unit])
    day = ts.cast("date")
    return (day if unit == "day" else F.trunc(day, unit)).cast("timestamp_ntz")


def local_to_instant(ts: Column, zone: str) -> Column:
    """The instant (timestamp_ltz) at which clocks in ``zone`` show ``ts``, whatever the session's zone. Null gives null."""
    return F.make_timestamp_ltz(*(_part(p, ts) for p in ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND")), F.lit(zone))
