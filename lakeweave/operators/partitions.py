"""Partition keys as data: enumerate, combine, window, and find what is missing."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.specs import PartitionDef, StaticPartition, TimePartition

# The format codes of keys; position and length in 'yyyy-MM-dd HH:mm:ss'.
_CODES = {"Y": (1, 4), "m": (6, 2), "d": (9, 2), "H": (12, 2), "M": (15, 2)}
_STEPS = {"year": "1 YEAR", "month": "1 MONTH", "week": "7 DAYS", "day": "1 DAY", "hour": "1 HOUR"}


def key_text(moment: Column, fmt: str) -> Column:
    """A TIMESTAMP_NTZ in a strftime format; no time zone takes part. Unknown codes raise."""
    text = moment.cast("string")
    parts = []
    for literal, code in re.findall(r"([^%]+)|%(.?)", fmt):
        if code in _CODES:
            parts.append(F.substring(text, *_CODES[code]))
        elif literal or code == "%":
            parts.append(F.lit(literal or code))
        else:
            raise ValueError(f"key format {fmt!r}: no rule for '%{code}'")
    return F.concat(*parts)


def period_start(moment: Column, period: str, weekday: int = 0) -> Column:
    """Start of the year, month, week (its first day: ``weekday``, 0 for Sunday), day or hour
    that holds ``moment``, by its wall clock, as TIMESTAMP_NTZ."""
    at = moment.cast("timestamp_ntz")
    day = at.cast("date")
    if period == "hour":
        return F.make_timestamp_ntz(F.year(at), F.month(at), F.dayofmonth(at), F.hour(at), F.lit(0), F.lit(0))
    if period == "week":
        day = F.date_sub(day, F.pmod(F.dayofweek(day) - 1 - weekday, F.lit(7)).cast("int"))
    elif period != "day":
        day = F.trunc(day, period)
    return day.cast("timestamp_ntz")


def time_keys_column(start: Column, as_of: Column, period: str = "year", fmt: str = "%Y", weekday: int = 0) -> Column:
    """Array of keys, one per period from ``start`` up to and including the period
    that contains ``as_of`` (the current, still open period is included)."""
    if period not in _STEPS:
        raise ValueError(f"unsupported period {period!r}")
    lo, hi = (period_start(c, period, weekday) for c in (start, as_of))
    starts = F.sequence(lo, hi, F.expr(f"INTERVAL {_STEPS[period]}"))
    return F.transform(starts, lambda t: key_text(t, fmt))


def time_keys(
    bounds: DataFrame, start: str, as_of: str, period: str = "year", fmt: str = "%Y", name: str = "partition_key", weekday: int = 0
) -> DataFrame:
    """One row per key. ``bounds`` holds one row with the start and as-of columns
    (typically a global min/max aggregate of the data, so the range follows it)."""
    return bounds.select(F.explode(time_keys_column(F.col(start), F.col(as_of), period, fmt, weekday)).alias(name))


def multi_keys(time_key_frame: DataFrame, statics: Sequence[StaticPartition]) -> DataFrame:
    """Keys of several dimensions: every time key with every static value, in
    dimension order. Expanded with a generator per dimension (no join)."""
    out = time_key_frame
    for s in statics:
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in s.values])).alias(s.name))
    return out


def run_keys(spec, key: str | dict[str, str] | None = None) -> dict[str, str]:
    """The partition tuple of one run (file or API table): a value for every partition
    column of ``spec`` and for nothing else, in its column order. A plain value can only
    stand for the key of a table with one partition column."""
    columns = [p.name for p in spec.partitions or ()]
    if key is None or isinstance(key, dict):
        given = dict(key or {})
    else:
        given = dict.fromkeys(columns, key) if len(columns) == 1 else {"": key}
    if set(given) != set(columns):
        raise ValueError(f"table {spec.name!r}: a run needs a value for each of {columns}, not {key!r}")
    return {c: given[c] for c in columns}


def key_window(key: str, part: TimePartition) -> tuple[date, date]:
    """(start_ds, end_ds) of a time key: first day of the window to the day before
    the next window starts."""
    start = datetime.strptime(key, part.format)
    if part.period == "year":
        nxt = start.replace(year=start.year + 1)
    elif part.period == "month":
        nxt = start.replace(year=start.year + (start.month == 12), month=start.month % 12 + 1)
    elif part.period == "week":
        nxt = start + timedelta(days=7)
    elif part.period in ("day", "hour"):
        nxt = start + timedelta(days=1)
    else:
        raise ValueError(part.period)
    return start.date(), (nxt - timedelta(days=1)).date()


def year_bounds(window: tuple[date, date]) -> tuple[int, int]:
    return window[0].year, window[1].year


def missing_keys(expected: DataFrame, present: DataFrame, key: str | Sequence[str] = "partition_key") -> DataFrame:
    """Expected keys that have no data yet (backfill list)."""
    keys = [key] if isinstance(key, str) else list(key)
    return expected.join(present.select(*keys).distinct(), keys, "left_anti")


def loaded_keys(partitions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of text values per loaded partition, from its catalog entry (``Lakehouse.partitions``): no data is read."""
    value = "split_part(element_at(filter(split(spec, '/'), p -> startswith(p, '{}=')), 1), '=', 2)"
    return partitions.select(*[F.url_decode(F.expr(value.format(c))).alias(c) for c in columns])


def expected_keys(spark: SparkSession, parts: Sequence[PartitionDef], as_of: datetime) -> DataFrame:
    """Every partition tuple of a table up to the period that holds ``as_of``, one column per partition."""
    out = spark.range(1).select()
    for p in parts:
        if isinstance(p, StaticPartition):
            keys = F.array(*[F.lit(v) for v in p.values])
        else:
            start, end = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (p.start, as_of))
            keys = time_keys_column(start, end, p.period, p.format, p.weekday)
        out = out.select("*", F.explode(keys).alias(p.name))
    return out


def common_partitioning(parents: dict[str, Sequence[PartitionDef] | None]) -> tuple[PartitionDef, ...] | None:
    """A child inherits its partitioned parents' definition; parents that differ are an error."""
    defs = {name: tuple(p) for name, p in parents.items() if p}
    distinct = set(defs.values())
    if len(distinct) > 1:
        raise ValueError(f"parents have different partitionings: {sorted(defs)}")
    return next(iter(distinct)) if distinct else None
