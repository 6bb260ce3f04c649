"""Date and time parsing for observation rows (SQL text + Column forms)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_yyyymmdd_sql(value: str) -> str:
    """Integer or string ``yyyymmdd`` -> DATE (strict: an invalid date raises under ANSI)."""
    return f"to_date(cast({value} as string), 'yyyyMMdd')"


def observed_at_sql(day: str, hhmm: str) -> str:
    """Day + ``hhmm`` (leading zeros may be lost) -> TIMESTAMP_NTZ; NULL for NULL or ''.

    The time is added as an interval rather than built with ``make_timestamp``, so
    ``2400`` rolls over to midnight of the next day instead of failing.
    """
    padded = f"lpad(cast({hhmm} as string), 4, '0')"
    return (
        f"CASE WHEN {hhmm} IS NOT NULL AND {hhmm} != '' THEN cast({day} as timestamp_ntz) + "
        f"make_dt_interval(0, cast(substring({padded}, 1, 2) as int), cast(substring({padded}, 3, 2) as int)) END"
    )


def parse_yyyymmdd(value: Column | str) -> Column:
    if isinstance(value, str):
        return F.expr(parse_yyyymmdd_sql(value))
    return F.to_date(value.cast("string"), "yyyyMMdd")


def observed_at(day: Column, hhmm: Column) -> Column:
    padded = F.lpad(hhmm.cast("string"), 4, "0")
    hours = F.substring(padded, 1, 2).cast("int")
    minutes = F.substring(padded, 3, 2).cast("int")
    return F.when(
        hhmm.isNotNull() & (hhmm != F.lit("")),
        day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours, minutes),
    )
