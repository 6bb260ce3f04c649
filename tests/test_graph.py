import pytest

from lakeweave.plans.build import build_all, models
from lakeweave.plans.checks import DECLARED_CHECKS
from lakeweave.plans.graph import Model, ModelGraph
from lakeweave.plans.raw import RawTables
from lakeweave.registry import present
from lakeweave.sinks.tables import Lakehouse
from lakeweave.specs import StaticPartition

from .conftest import SF_SMALL


def test_edges_are_what_the_models_read(spark):
    graph = ModelGraph(models(RawTables(spark, SF_SMALL)))
    assert set(graph.parents["curated.stations"]) == {"cleansed.stations", "cleansed.countries", "cleansed.states"}
    assert graph.parents["reporting.snow_cold"] == ("curated.station_year",)
    order = graph.order()
    assert all(order.index(p) < order.index(c) for c, own in graph.parents.items() for p in own)
    assert graph.select(["cleansed.stations"], downstream=True)[-1].startswith("reporting.")
    assert set(graph.select(["curated.station_year"], upstream=True)) >= {"raw.observations", "cleansed.observations", "curated.stations"}
    assert "cleansed.inventory" not in graph.select(["curated.station_year"], upstream=True, downstream=True)
    assert [p.name for p in graph.partitions["reporting.country_year"]] == ["YEAR"]  # inherited down the chain
    assert graph.partitions["reporting.station_coverage"] is None
    with pytest.raises(ValueError, match="no such models"):
        graph.select(["curated.nothing"])


def test_graphs_that_cannot_be_built_fail_before_any_job(spark):
    one = spark.range(1)
    ring = {"a.x": Model(lambda t: t["a.y"]), "a.y": Model(lambda t: t["a.x"])}
    with pytest.raises(ValueError, match="a.x -> a.y -> a.x"):
        ModelGraph(ring)
    with pytest.raises(ValueError, match="a.x reads a.z"):
        ModelGraph({"a.x": Model(lambda t: t["a.z"])})
    unlike = {
        "a.x": Model(lambda t: one, partitions=(StaticPartition("k", ("1",)),)),
        "a.y": Model(lambda t: one, partitions=(StaticPartition("k", ("2",)),)),
        "a.z": Model(lambda t: t["a.x"].union(t["a.y"])),
    }
    with pytest.raises(ValueError, match="a.z: parents have different partitionings"):
        ModelGraph(unlike)


def test_a_selection_builds_on_what_is_there(spark):
    lh, raw = Lakehouse.scratch(spark), RawTables(spark, SF_SMALL)
    build_all(lh, raw, DECLARED_CHECKS, select=["reporting.country_year"], upstream=True)
    assert not lh.exists("reporting", "snow_cold") and not lh.exists("cleansed", "inventory")
    versions = {n: lh.version(*n.split(".")) for n in ("cleansed.observations", "curated.stations", "curated.observations")}
    built = build_all(lh, raw, DECLARED_CHECKS, select=["curated.station_year"], downstream=True)
    assert {n: lh.version(*n.split(".")) for n in versions} == versions
    assert lh.counted["curated.station_year"]["station_id not_null"] == 0
    whole = build_all(Lakehouse.scratch(spark), raw)
    for name in ("reporting.country_year", "reporting.snow_cold", "reporting.global_year"):
        assert sorted(map(str, present(built[name]).collect())) == sorted(map(str, present(whole[name]).collect()))
