"""Data-quality keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.operators import quality as Q
from lakeweave.plans import bindings
from lakeweave.plans.build import build_all
from lakeweave.plans.checks import DECLARED_CHECKS
from lakeweave.plans.chain import LayerChain
from lakeweave.plans.raw import RawTables
from lakeweave.registry import register
from lakeweave.sinks.tables import Lakehouse


@register("dq_not_null")
def dq_not_null(spark, d):
    """Declared not-null columns of cleansed observations plus quality_flag (mostly NULL)."""
    obs = LayerChain(spark, d).observations
    return Q.not_null_failures(obs, ["station_id", "observation_date", "measure", "quality_flag"])


@register("dq_unique")
def dq_unique(spark, d):
    """Duplicated key values per column: clean keys (0) and a known-duplicated one."""
    t = lambda n: bindings.table(spark, d, n)
    cases = [
        ("customer", "c_custkey", t("customer")),
        ("orders", "o_orderkey", t("orders")),
        ("lineitem", "l_orderkey", t("lineitem")),
        ("cleansed.stations", "id", LayerChain(spark, d).stations),
    ]
    out = None
    for model, col, df in cases:
        row = Q.duplicate_values(df, [col]).agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
            F.lit(model).alias("model"), F.lit(col).alias("column_name"), "failures"
        )
        out = row if out is None else out.unionByName(row)
    return out


@register("dq_relationships")
def dq_relationships(spark, d):
    """Orphan child rows: documents without a label, and the clean pairs observations and
    inventory vs stations, stations vs countries, line items vs orders."""
    p = LayerChain(spark, d)
    cases = [
        ("cleansed.observations", "station_id", "cleansed.stations", p.observations, p.stations, "id"),
        ("cleansed.inventory", "station_id", "cleansed.stations", p.inventory, p.stations, "id"),
        ("cleansed.stations", "country_id", "cleansed.countries", p.stations, p.countries, "id"),
        ("lineitem", "l_orderkey", "orders", bindings.table(spark, d, "lineitem"), bindings.table(spark, d, "orders"), "o_orderkey"),
        ("documents", "doc_id", "labels", bindings.table(spark, d, "documents"), bindings.table(spark, d, "labels"), "doc_id"),
    ]
    out = None
    for model, col, parent, child_df, parent_df, pcol in cases:
        row = Q.orphan_count(child_df, col, parent_df, pcol).select(
            F.lit(model).alias("model"), F.lit(col).alias("column_name"), F.lit(parent).alias("parent"), "failures"
        )
        out = row if out is None else out.unionByName(row)
    return out


@register("dq_unique_combo")
def dq_unique_combo(spark, d):
    """Repeated (l_orderkey, l_linenumber) pairs: the failing rows of a composite check."""
    return Q.duplicate_values(bindings.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_suite")
def dq_suite(spark, d):
    """Build all layers into a private lakehouse, then run the 34 declared checks (not-null ones count in the writes)."""
    lh = Lakehouse.scratch(spark)
    tables = build_all(lh, RawTables(spark, d), DECLARED_CHECKS)
    return Q.run_suite(tables, DECLARED_CHECKS, lh.counted)
