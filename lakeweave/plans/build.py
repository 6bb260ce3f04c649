"""Build every layer into a lakehouse in lineage order.

Each model reads its parents from their persisted tables, so lineage is cut at every
layer (no plan grows with the chain, and a lost executor costs at most one model's
recomputation). Returns the persisted tables by ``layer.name``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from lakeweave.operators.quality import Check, assert_passing, row_conditions, run_suite
from lakeweave.plans import bindings, cleansed, curated, reporting
from lakeweave.plans.graph import Model, ModelGraph
from lakeweave.plans.raw import RawTables
from lakeweave.sinks.tables import Lakehouse
from lakeweave.specs import TimePartition

OBS_ORDER = ["observation_date", "station_id", "measure"]


class _Tables(dict):
    """Persisted tables by ``layer.name``; with ``fail_fast``, those of a model's declared
    checks that its load has not counted run as soon as it is stored and a failure stops everything downstream."""

    def __init__(self, lh: Lakehouse, checks: list[Check], fail_fast: bool):
        super().__init__()
        self.lh, self.checks, self.fail_fast = lh, checks, fail_fast

    def __setitem__(self, key, df):
        super().__setitem__(key, df)
        if not self.fail_fast:
            return
        mine = [c for c in self.checks if c.model == key and not (c.test == "not_null" and key in self.lh.counted)]
        if mine:
            assert_passing(run_suite(self, mine))


def models(raw: RawTables) -> dict[str, Model]:
    """Every model; what it reads is seen from its own code (``ModelGraph``), so the order here means nothing."""
    out = {
        "raw.countries": Model(lambda t: raw.countries()),
        "raw.states": Model(lambda t: raw.states()),
        "raw.stations": Model(lambda t: raw.stations()),
        "raw.observations": Model(
            lambda t: raw.observations(), ("YEAR",), overwrite=True, partitions=(TimePartition("YEAR", datetime(1995, 1, 1)),)
        ),
        "raw.inventory": Model(lambda t: bindings_inventory(raw, t["raw.observations"])),
    }
    for name, df in bindings.seed_frames(raw.spark, raw.sf_dir).items():
        out[f"raw.{name}"] = Model(lambda t, df=df: df)
        out[f"cleansed.{name}"] = Model(lambda t, name=name: cleansed.flags_view(t[f"raw.{name}"]), view_of=f"raw.{name}")
    return out | {
        "cleansed.countries": Model(lambda t: cleansed.countries(t["raw.countries"])),
        "cleansed.states": Model(lambda t: cleansed.states(t["raw.states"])),
        "cleansed.stations": Model(lambda t: cleansed.stations(t["raw.stations"])),
        "cleansed.inventory": Model(lambda t: cleansed.inventory(t["raw.inventory"])),
        "cleansed.observations": Model(
            lambda t: cleansed.observations(t["raw.observations"]), ("observation_year",), tuple(OBS_ORDER), overwrite=True
        ),
        "curated.stations": Model(
            lambda t: curated.stations(t["cleansed.stations"], t["cleansed.countries"], t["cleansed.states"])
        ),
        "curated.observations": Model(
            lambda t: curated.observations(t["cleansed.observations"], t["curated.stations"]), ("observation_year",)
        ),
        "curated.station_year": Model(lambda t: curated.station_year_from_obt(t["curated.observations"])),
        "reporting.country_year": Model(lambda t: reporting.country_year(t["curated.station_year"])),
        "reporting.global_year": Model(lambda t: reporting.global_year(t["curated.station_year"])),
        "reporting.snow_cold": Model(lambda t: reporting.snow_cold(t["curated.station_year"])),
        "reporting.station_coverage": Model(lambda t: reporting.station_coverage(t["curated.stations"])),
    }


def build_all(
    lh: Lakehouse,
    raw: RawTables,
    checks: list[Check] | None = None,
    fail_fast: bool = False,
    select: Sequence[str] | None = None,
    upstream: bool = False,
    downstream: bool = False,
) -> dict[str, DataFrame]:
    """Build every model, or the selected ones with those above or below them, parents first.

    Parents that are not selected are read as they are in the lakehouse. The not-null checks among the given
    ones are counted by each model's own write (``lh.counted``). With ``fail_fast`` they keep a failing model
    from being published, the other checks run after each model (as a build tool does), and the first
    failing model stops the build. Models that read each other, and parents with unlike partitionings, fail
    before any job starts.
    """
    checks = checks or []
    graph = ModelGraph(models(raw), [(c.model, c.to_model) for c in checks if c.to_model] if fail_fast else ())
    t = _Tables(lh, checks, fail_fast)
    names = graph.order() if select is None else graph.select(select, upstream, downstream)
    for name in names:
        for parent in graph.needs[name]:
            if parent not in t:  # not selected
                dict.__setitem__(t, parent, lh.table(*parent.split(".")))
        model, (layer, table) = graph.models[name], name.split(".")
        if model.view_of:
            t[name] = lh.view(layer, table, *model.view_of.split("."))
            continue
        load = {"expect": row_conditions(checks, name), "strict": fail_fast}
        if model.overwrite:
            t[name] = lh.insert_overwrite(layer, table, model.rows(t), model.partition_by, model.order_by, **load)
        else:
            t[name] = lh.full_refresh(layer, table, model.rows(t), model.partition_by, **load)
    return dict(t)


def bindings_inventory(raw: RawTables, raw_obs: DataFrame) -> DataFrame:
    from lakeweave.plans.layouts import INVENTORY_LAYOUT
    from lakeweave.sources.files import read_layout_lines

    return read_layout_lines(bindings.inventory_lines(raw_obs), INVENTORY_LAYOUT)
