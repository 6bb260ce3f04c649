import os

from pyspark.sql import functions as F

from lakeweave.plans import bindings, cleansed, curated, reporting
from lakeweave.plans.chain import LayerChain
from lakeweave.registry import present
from lakeweave.sinks.tables import Lakehouse
from lakeweave.streaming.marts import MARTS, PARTIALS, incremental_marts, merge_years, touched_years

from .conftest import SF_SMALL


def _files(lh, layer, table):
    """Data files of the version shown, by year."""
    out = {}
    for r in lh.partitions(layer, table).collect():
        out[r.spec] = {f"{r.location}/{f}" for f in os.listdir(r.location) if f.endswith(".parquet")}
    return out


def _rows(df):
    return sorted(map(str, present(df).select(sorted(df.columns)).collect()))


def test_only_touched_years_are_written_and_equal_a_rebuild(spark, tmp_root):
    lh, raw = Lakehouse.scratch(spark), bindings.raw_observations(spark, SF_SMALL).cache()
    stations = lh.full_refresh("curated", "stations", LayerChain(spark, SF_SMALL).curated_stations)
    land = lambda rows: rows.write.mode("append").partitionBy("YEAR").parquet(f"{tmp_root}/raw")
    run = lambda **kw: incremental_marts(spark, lh, f"{tmp_root}/raw", raw.schema, stations, f"{tmp_root}/ckpt", **kw)
    tables = [("curated", "station_year"), *(m[0] for m in MARTS)]

    def check(rows):
        fact = curated.station_year(cleansed.observations(rows), stations)
        assert _rows(lh.table("curated", "station_year")) == _rows(fact)
        for table, _, fn in MARTS:
            assert _rows(lh.table(*table)) == _rows(fn(fact))

    first = raw.where("DATE < 19980615 AND DATE % 2 = 0")
    land(first)
    run(max_files_per_trigger=2)  # a year's files come in several batches
    check(first)
    before = {t: _files(lh, *t) for t in tables}
    second = raw.where("DATE >= 19980615")
    land(second)
    run()
    check(first.union(second))
    for t in tables:
        after = _files(lh, *t)
        for spec, files in before[t].items():
            year = int(spec.split("=")[1])
            assert (after[spec] == files) == (year < 1998), (t, spec)
    versions = {t: lh.version(*t) for t in (PARTIALS, *tables)}
    run()
    assert {t: lh.version(*t) for t in (PARTIALS, *tables)} == versions  # nothing new, nothing written


def test_a_batch_that_runs_again_counts_once(spark):
    lh, raw = Lakehouse.scratch(spark), bindings.raw_observations(spark, SF_SMALL)
    stations = LayerChain(spark, SF_SMALL).curated_stations
    halves = [raw.where("DATE % 2 = 0"), raw.where("DATE % 2 = 1")]
    for load, rows in [(0, halves[0]), (1, halves[1]), (1, halves[1])]:
        partials = curated.station_year_partials(cleansed.observations(rows)).withColumn("load", F.lit(load).cast("bigint"))
        lh.insert_overwrite(*PARTIALS, partials, ["observation_year", "load"])
        merge_years(lh, touched_years(lh, load), stations)
    assert _rows(lh.table("reporting", "country_year")) == _rows(
        reporting.country_year(curated.station_year(cleansed.observations(raw), stations))
    )
    assert touched_years(lh, 7) == []
