"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Outputs pass through ``present``: DECIMAL as DOUBLE, DATE as ISO text, TIMESTAMP as
ISO text with microseconds and DOUBLE rounded to 9 then 6 places. Row order and last-bit float differences between
partitionings (and between engines) then do not change the checked values; the
library functions themselves keep the native types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query key {name}")
        _QUERIES[name] = fn
        return fn

    return deco


def present(df: DataFrame, decimals: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            # two steps: the first absorbs last-bit differences of summation order, so a
            # value on a rounding tie rounds the same way in every engine and run
            c = F.round(F.round(c.cast("double"), decimals + 3), decimals)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def queries() -> dict[str, QueryFn]:
    import lakeweave.queries  # noqa: F401  (registers everything)

    return {k: (lambda spark, sf_dir, _f=fn: present(_f(spark, sf_dir))) for k, fn in _QUERIES.items()}


def raw_queries() -> dict[str, QueryFn]:
    import lakeweave.queries  # noqa: F401

    return dict(_QUERIES)
