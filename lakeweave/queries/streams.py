"""Incremental stream keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.plans import bindings
from lakeweave.plans import events as E
from lakeweave.plans.bindings import table
from lakeweave.plans.chain import LayerChain
from lakeweave.registry import register
from lakeweave.session import fresh_dir
from lakeweave.sinks.tables import Lakehouse
from lakeweave.sources.files import ntz_literal
from lakeweave.streaming.incremental import incremental_partition_refresh
from lakeweave.streaming.marts import incremental_marts


@register("stream_incremental_cleanse")
def stream_incremental_cleanse(spark, d):
    """Events land in two goes, split at the middle of their time range (so one day
    receives files in both); each go is followed by an incremental run."""
    ev = table(spark, d, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    cut = lo + (hi - lo) / 2
    root = fresh_dir(spark, "stream")
    raw, ckpt = f"{root}/raw/events", f"{root}/_checkpoints/cleanse-events"
    lh = Lakehouse.scratch(spark)
    run = lambda: incremental_partition_refresh(
        spark, lh, raw, E.RAW_EVENT_SCHEMA, "event_date", E.cleanse, "cleansed", "events", ckpt, ["ts", "event_id"]
    )
    E.land(ev.filter(F.col("ts") < ntz_literal(cut)), raw)
    run()
    E.land(ev.filter(F.col("ts") >= ntz_literal(cut)), raw)
    run()
    return run()  # nothing new: a no-op that returns the table


def _land_readings(rows, path: str) -> None:
    rows.write.mode("append").partitionBy("YEAR").parquet(path)


@register("stream_incremental_marts")
def stream_incremental_marts(spark, d):
    """Readings land in two goes, split inside a year; each go is followed by an incremental run, which merges the
    new readings' partials into the touched years, and a third run finds nothing. The country-year mart equals a rebuild."""
    chain, root = LayerChain(spark, d), fresh_dir(spark, "marts")
    lh, raw = Lakehouse.scratch(spark), bindings.raw_observations(spark, d)
    stations = lh.full_refresh("curated", "stations", chain.curated_stations)
    run = lambda: incremental_marts(spark, lh, f"{root}/raw", raw.schema, stations, f"{root}/_checkpoint")
    for rows in (raw.where("DATE < 19980615"), raw.where("DATE >= 19980615")):
        _land_readings(rows, f"{root}/raw")
        run()
    run()
    return lh.table("reporting", "country_year")
