"""The weather layers for one table directory, wired in lineage order.

Every property is a lazy DataFrame; nothing runs until an action. Layers are not
persisted here, so Catalyst plans each requested output end to end (column pruning
reaches the Parquet scans); a production run persists layers with ``lakeweave.sinks``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakeweave.plans import cleansed, curated, reporting
from lakeweave.plans.raw import RawTables


class LayerChain:
    def __init__(self, spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None):
        self.spark, self.sf_dir, self.years = spark, sf_dir, years
        self.raw = RawTables(spark, sf_dir)

    # cleansed
    @cached_property
    def countries(self) -> DataFrame:
        return cleansed.countries(self.raw.countries())

    @cached_property
    def states(self) -> DataFrame:
        return cleansed.states(self.raw.states())

    @cached_property
    def stations(self) -> DataFrame:
        return cleansed.stations(self.raw.stations())

    @cached_property
    def inventory(self) -> DataFrame:
        return cleansed.inventory(self.raw.inventory())

    @cached_property
    def observations(self) -> DataFrame:
        return cleansed.observations(self.raw.observations(), self.years)

    # curated
    @cached_property
    def curated_stations(self) -> DataFrame:
        return curated.stations(self.stations, self.countries, self.states)

    @cached_property
    def curated_observations(self) -> DataFrame:
        return curated.observations(self.observations, self.curated_stations)

    @cached_property
    def station_year(self) -> DataFrame:
        return curated.station_year(self.observations, self.curated_stations)

    # reporting
    @cached_property
    def country_year(self) -> DataFrame:
        return reporting.country_year(self.station_year)

    @cached_property
    def global_year(self) -> DataFrame:
        return reporting.global_year(self.station_year)

    @cached_property
    def snow_cold(self) -> DataFrame:
        return reporting.snow_cold(self.station_year)

    @cached_property
    def station_coverage(self) -> DataFrame:
        return reporting.station_coverage(self.curated_stations)
