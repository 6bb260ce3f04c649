"""Data-quality checks as Spark jobs. Each returns failing rows or a failure count;
a suite returns one row per check.

Counting is skew-safe: keys are pre-aggregated (partial aggregation collapses a hot
key inside each map task) before any shuffle or join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    model: str
    test: str  # not_null | unique | relationships | unique_combination
    columns: tuple[str, ...]
    to_model: str | None = None
    to_column: str | None = None

    def __post_init__(self):
        if self.test not in ("not_null", "unique", "relationships", "unique_combination"):
            raise ValueError(f"unknown test {self.test!r}")
        if self.test == "relationships" and not (self.to_model and self.to_column):
            raise ValueError("relationships needs to_model and to_column")


def not_null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures) for several columns in a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures").select(
        "column_name", F.col("failures").cast("bigint").alias("failures")
    )


def duplicate_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-NULL key values (single or composite) seen more than once, with the count."""
    cond = None
    for c in columns:
        nn = F.col(c).isNotNull()
        cond = nn if cond is None else cond & nn
    return (
        df.filter(cond)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(parent_key).alias("__pk")).filter(F.col("__pk").isNotNull()).distinct()
    c = child.filter(F.col(child_key).isNotNull())
    return c.join(keys, c[child_key] == keys["__pk"], "left_anti")


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Number of orphan child rows, one row ``failures``. Child keys are counted first,
    so only distinct keys reach the anti join."""
    per_key = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("__ck")).agg(
        F.count(F.lit(1)).alias("n")
    )
    keys = parent.select(F.col(parent_key).alias("__pk")).filter(F.col("__pk").isNotNull()).distinct()
    orphans = per_key.join(keys, per_key["__ck"] == keys["__pk"], "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures"))


def _row(check: Check, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(check.model).alias("model"),
        F.lit(",".join(check.columns)).alias("column_name"),
        F.lit(check.test).alias("test"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def row_conditions(checks: Sequence[Check], model: str) -> dict[str, str]:
    """Conditions of the rows that fail the not-null checks of ``model``, by name, for a load's ``expect``."""
    return {f"{c.columns[0]} not_null": f"`{c.columns[0]}` IS NULL" for c in checks if c.model == model and c.test == "not_null"}


def run_suite(
    models: Mapping[str, DataFrame], checks: Sequence[Check], counted: Mapping[str, Mapping[str, int]] | None = None
) -> DataFrame:
    """One row per check: (model, column_name, test, failures).

    Not-null checks that the load of a model ``counted`` (``Lakehouse.counted``) cost no scan; the others of one model
    share one, the rest are one aggregation (or one anti join) each. The result is a union of small aggregates.
    """
    parts: list[DataFrame] = []
    nn: dict[str, list[str]] = {}
    known: list[tuple[str, str, str, int]] = []
    for c in checks:
        if c.test == "not_null":
            n = (counted or {}).get(c.model, {}).get(f"{c.columns[0]} not_null")
            if n is None:
                nn.setdefault(c.model, []).append(c.columns[0])
            else:
                known.append((c.model, c.columns[0], c.test, n))
    if known:
        spark = next(iter(models.values())).sparkSession
        parts.append(spark.createDataFrame(known, "model string, column_name string, test string, failures bigint"))
    for model, cols in nn.items():
        parts.append(
            not_null_failures(models[model], cols).select(
                F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures"
            )
        )
    for c in checks:
        if c.test in ("unique", "unique_combination"):
            dup = duplicate_values(models[c.model], c.columns)
            parts.append(_row(c, dup.agg(F.count(F.lit(1)).alias("failures"))))
        elif c.test == "relationships":
            parts.append(_row(c, orphan_count(models[c.model], c.columns[0], models[c.to_model], c.to_column)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_passing(results: DataFrame) -> None:
    """Raise if any check failed (the verdict is a small, bounded collect)."""
    bad = results.filter(F.col("failures") > 0).collect()
    if bad:
        raise AssertionError("data checks failed: " + "; ".join(f"{r.model}.{r.column_name} {r.test}={r.failures}" for r in bad))
