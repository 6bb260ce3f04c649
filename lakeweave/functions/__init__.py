"""Column expressions used by the layer jobs (all Spark built-ins).

Each rule exists once as SQL text (``*_sql``, for ``selectExpr``) and as a Column.
"""

from lakeweave.functions.text import byte_substring, byte_substring_sql, fixed_width_sql
from lakeweave.functions.time import observed_at, observed_at_sql, parse_yyyymmdd, parse_yyyymmdd_sql
from lakeweave.functions.units import TENTHS_ELEMENTS, normalized_value, normalized_value_sql

__all__ = [
    "byte_substring",
    "byte_substring_sql",
    "fixed_width_sql",
    "observed_at",
    "observed_at_sql",
    "parse_yyyymmdd",
    "parse_yyyymmdd_sql",
    "TENTHS_ELEMENTS",
    "normalized_value",
    "normalized_value_sql",
]
