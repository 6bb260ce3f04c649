"""Unit normalization, applied once in the curated layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements recorded in tenths of their unit (tenths of degrees C,
# tenths of mm). Every other element is already in its native unit.
TENTHS_ELEMENTS = ("TMAX", "TMIN", "TAVG", "PRCP")


def normalized_value_sql(measure: str, value: str) -> str:
    """Tenths elements / 10 as DOUBLE (``10.0D``: a bare ``10.0`` would be DECIMAL)."""
    elems = ", ".join(f"'{e}'" for e in TENTHS_ELEMENTS)
    return f"CASE WHEN {measure} IN ({elems}) THEN {value} / 10.0D ELSE cast({value} as double) END"


def normalized_value(measure: Column | str, value: Column | str) -> Column:
    if isinstance(measure, str) and isinstance(value, str):
        return F.expr(normalized_value_sql(measure, value))
    return F.when(measure.isin(*TENTHS_ELEMENTS), value / F.lit(10.0)).otherwise(value.cast("double"))
