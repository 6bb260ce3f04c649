"""Checked-in lookup tables (CSV with a header, explicit two-column schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SEED_SCHEMA = "id string, description string"


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """IDs stay case-sensitive strings (``A`` and ``a`` are different flags)."""
    return spark.read.schema(SEED_SCHEMA).csv(path, header=True, mode="FAILFAST", enforceSchema=False)
