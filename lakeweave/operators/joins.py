"""Dimension lookups.

No broadcast hints: Spark broadcasts a side only when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with the real size at run
time, falling back to a sort-merge join (with skew splitting) beyond it. That is the
size check; a station dimension that grows with the data is never forced into memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: dict[str, str],
    how: str = "left",
) -> DataFrame:
    """Left-join ``dim`` on ``fact_key = dim_key`` and add ``columns`` (dim name -> new name).

    The dimension is projected to the key and wanted columns first, so only those are
    shuffled or broadcast. Unmatched rows keep SQL NULLs.
    """
    key_alias = f"__{dim_key}_key"
    d = dim.select(F.col(dim_key).alias(key_alias), *[F.col(c).alias(n) for c, n in columns.items()])
    return fact.join(d, fact[fact_key] == d[key_alias], how).drop(key_alias)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key is missing from the parent (left anti join)."""
    keys = parent.select(F.col(parent_key).alias("__parent_key")).filter(F.col("__parent_key").isNotNull())
    c = child.filter(F.col(child_key).isNotNull())
    return c.join(keys, c[child_key] == keys["__parent_key"], "left_anti")
