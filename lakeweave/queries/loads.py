"""Sink and partition keys: loads run twice (or more) against a private lakehouse,
then the final table is returned."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lakeweave.functions.paths import hive_path
from lakeweave.operators import partitions as P
from lakeweave.plans import bindings
from lakeweave.plans.api_pages import api_records
from lakeweave.plans.chain import LayerChain
from lakeweave.plans.ingest import Backfilled, backfill, ingest_table
from lakeweave.registry import register
from lakeweave.session import fresh_dir
from lakeweave.sinks.files import write_files
from lakeweave.sinks.tables import Lakehouse, RejectedLoad
from lakeweave.specs import FileFormat, Source, SourceSpec, StaticPartition, TimePartition

OBS_ORDER = ["observation_date", "station_id", "measure"]


@register("sink_full_refresh")
def sink_full_refresh(spark, d):
    """cleansed.stations refreshed twice; the second publish replaces the first."""
    lh = Lakehouse.scratch(spark)
    stations = LayerChain(spark, d).stations
    lh.full_refresh("cleansed", "stations", stations)
    lh.full_refresh("cleansed", "stations", stations)
    return lh.table("cleansed", "stations")


@register("sink_full_refresh_schema")
def sink_full_refresh_schema(spark, d):
    """raw.orders refreshed twice; the second refresh drops one column and adds another."""
    lh = Lakehouse.scratch(spark)
    orders = bindings.table(spark, d, "orders")
    lh.full_refresh("raw", "orders", orders.select("o_orderkey", "o_totalprice"))
    lh.full_refresh("raw", "orders", orders.select("o_orderkey", "o_custkey"))
    return lh.table("raw", "orders")


@register("sink_view")
def sink_view(spark, d):
    """A view over raw.suppliers, made before the table is refreshed: it shows the new rows."""
    lh = Lakehouse.scratch(spark)
    suppliers = bindings.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    lh.full_refresh("raw", "suppliers", suppliers.where("s_nationkey < 5"))
    lh.view("cleansed", "suppliers", "raw", "suppliers", "s_suppkey AS id, trim(s_name) AS name")
    lh.full_refresh("raw", "suppliers", suppliers)
    return lh.table("cleansed", "suppliers")


@register("sink_copy")
def sink_copy(spark, d):
    """raw.orders copied with its rows; a second copy finds the target and leaves it alone."""
    lh = Lakehouse.scratch(spark)
    orders = bindings.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    lh.full_refresh("raw", "orders", orders)
    lh.copy_table("raw", "orders", "curated", "orders")
    lh.full_refresh("raw", "orders", orders.where("o_custkey < 10"))
    return lh.copy_table("raw", "orders", "curated", "orders")


@register("sink_partition_replace")
def sink_partition_replace(spark, d):
    """raw.observations loaded, then YEAR=1997 replaced (twice) by its QC-passing rows:
    exactly that partition changes, the others are untouched, the re-run is a no-op."""
    lh = Lakehouse.scratch(spark)
    raw = bindings.raw_observations(spark, d)
    lh.insert_overwrite("raw", "observations", raw, ["YEAR"])
    slice_1997 = raw.filter((F.col("YEAR") == 1997) & F.col("Q_FLAG").isNull())
    lh.replace_partition("raw", "observations", slice_1997, {"YEAR": 1997})
    lh.replace_partition("raw", "observations", slice_1997, {"YEAR": 1997})
    return lh.table("raw", "observations")


@register("sink_insert_overwrite")
def sink_insert_overwrite(spark, d):
    """cleansed.observations: first run unfiltered, then the incremental run for key
    1997 (window 1997-01-01..1997-12-31 -> YEAR between 1997 and 1997) rewrites only
    that year; all other years stay."""
    lh = Lakehouse.scratch(spark)
    p = LayerChain(spark, d)
    lh.insert_overwrite("cleansed", "observations", p.observations, ["observation_year"], OBS_ORDER)
    part = TimePartition("YEAR", datetime(1995, 1, 1))
    years = P.year_bounds(P.key_window("1997", part))
    inc = LayerChain(spark, d, years=years).observations
    lh.insert_overwrite("cleansed", "observations", inc, ["observation_year"], OBS_ORDER)
    return lh.table("cleansed", "observations")


@register("sink_overwrite_atomic")
def sink_overwrite_atomic(spark, d):
    """Readings a year as a reader opened before two loads of 1996 and 1997 sees them, and as the table has them
    afterwards. The first load holds readings that failed QC, which its expectation forbids: nothing of
    it is published. The second holds the passing ones: both years are replaced at once."""
    lh = Lakehouse.scratch(spark)
    raw = bindings.raw_observations(spark, d)
    before = lh.insert_overwrite("raw", "observations", raw, ["YEAR"])
    two_years, expect = raw.where("YEAR BETWEEN 1996 AND 1997"), {"failed QC": "Q_FLAG IS NOT NULL"}
    try:
        lh.insert_overwrite("raw", "observations", two_years, ["YEAR"], expect=expect)
    except RejectedLoad:
        pass
    after = lh.insert_overwrite("raw", "observations", two_years.where("Q_FLAG IS NULL"), ["YEAR"], expect=expect)
    counts = [t.groupBy("YEAR").agg(F.count("*").alias("n"), F.count("Q_FLAG").alias("failed")) for t in (before, after)]
    return counts[0].select(F.lit("before").alias("seen"), "*").unionAll(counts[1].select(F.lit("after").alias("seen"), "*"))


@register("sink_expire")
def sink_expire(spark, d):
    """raw.orders by priority, each priority loaded again on its own, then superseded versions expired: the
    rows are those of the last loads, and no folder or version is left but what the table shows."""
    lh = Lakehouse.scratch(spark)
    orders = bindings.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lh.insert_overwrite("raw", "orders", orders, ["o_orderpriority"])
    for p in ("1-URGENT", "3-MEDIUM"):
        lh.replace_partition("raw", "orders", orders.where(F.col("o_orderpriority") == p).where("o_custkey % 2 = 0"), {"o_orderpriority": p})
    lh.expire("raw", "orders", older_than=timedelta(0))
    versions = F.lit(lh.ledger("raw", "orders").select("version").distinct().count()).cast("bigint").alias("versions")
    counts = lh.table("raw", "orders").groupBy("o_orderpriority")
    return counts.agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key")).select("*", versions)


@register("part_backfill")
def part_backfill(spark, d):
    """Line items landed by shipping year; 1996 is loaded on its own, a backfill to 1998 loads the missing years from 1994
    on, and a second backfill finds nothing to do. Rows per year, with the runs that loaded it."""
    lh, root = Lakehouse.scratch(spark), fresh_dir(spark, "landing")
    lines = bindings.table(spark, d, "lineitem").selectExpr("l_orderkey", "l_quantity", "year(l_shipdate) AS YEAR")
    write_files(lines, FileFormat.PARQUET, hive_path(root, "shop", "lines"), ["YEAR"])
    spec = SourceSpec("lines", FileFormat.PARQUET, partitions=(TimePartition("YEAR", datetime(1994, 1, 1)),))
    source, at = Source("shop", "s3", (spec,)), datetime(1998, 6, 1)
    ingest_table(lh, source, "lines", root, at, "1996")
    runs = [[Backfilled({"YEAR": "1996"}, "loaded")]] + [backfill(lh, source, "lines", root, at, at) for _ in range(2)]
    rows = [(int(b.key["YEAR"]), i) for i, run in enumerate(runs) for b in run if b.state == "loaded"]
    loaded = spark.createDataFrame(rows, "YEAR int, run int")
    counts = lh.table("raw", "shop_lines").groupBy("YEAR").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
    return counts.join(loaded, "YEAR").select("YEAR", "run", "n", "quantity")


@register("sink_append")
def sink_append(spark, d):
    """API disposition ``append``: the same pages loaded twice are stored twice."""
    lh = Lakehouse.scratch(spark)
    rec = api_records(spark, d).select("id", "date", "value", "YEAR")
    lh.load("raw", "gdp", rec, "append", ["YEAR"])
    lh.load("raw", "gdp", rec, "append", ["YEAR"])
    return lh.table("raw", "gdp")


@register("sink_replace")
def sink_replace(spark, d):
    """API disposition ``replace``: a second load replaces the first."""
    lh = Lakehouse.scratch(spark)
    rec = api_records(spark, d).select("id", "date", "value", "YEAR")
    lh.load("raw", "gdp", rec, "replace", ["YEAR"])
    lh.load("raw", "gdp", rec, "replace", ["YEAR"])
    return lh.table("raw", "gdp")


def _order_bounds(spark, d):
    return bindings.table(spark, d, "orders").agg(
        F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("as_of")
    )


@register("part_time_keys")
def part_time_keys(spark, d):
    """Yearly, monthly, weekly (from Monday) and daily keys from the first order date through
    the period of the last; one pass over the dates."""
    formats = {"year": "%Y", "month": "%Y-%m", "week": "%Y-%m-%d", "day": "%Y-%m-%d"}
    start, as_of = F.col("start"), F.col("as_of")
    keys = [
        F.struct(F.lit(p).alias("period"), P.time_keys_column(start, as_of, p, fmt, weekday=1).alias("keys"))
        for p, fmt in formats.items()
    ]
    periods = _order_bounds(spark, d).select(F.inline(F.array(*keys)))
    return periods.select("period", F.explode("keys").alias("partition_key"))


@register("part_multi_keys")
def part_multi_keys(spark, d):
    """(YEAR, S_FLAG) keys: yearly time keys with the static source-flag values."""
    years = P.time_keys(_order_bounds(spark, d), "start", "as_of", "year", "%Y", name="YEAR")
    return P.multi_keys(years, [StaticPartition("S_FLAG", ("F", "O"))])


@register("part_missing")
def part_missing(spark, d):
    """Monthly partitions expected up to the last ship date that have no orders yet."""
    o = bindings.table(spark, d, "orders")
    li = bindings.table(spark, d, "lineitem")
    # both bounds from one global aggregate over the stacked dates (no join)
    bounds = (
        o.select(F.col("o_orderdate").alias("start"), F.lit(None).cast("timestamp_ntz").alias("end"))
        .unionByName(li.select(F.lit(None).cast("timestamp_ntz").alias("start"), F.col("l_shipdate").alias("end")))
        .agg(F.min("start").alias("start"), F.max("end").alias("as_of"))
    )
    expected = P.time_keys(bounds, "start", "as_of", "month", "%Y-%m")
    present = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("partition_key"))
    return P.missing_keys(expected, present)
