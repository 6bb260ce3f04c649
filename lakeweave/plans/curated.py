"""Curated layer: denormalized station dimension, observation one-big-table, and the
station-year fact (first stage of every two-stage average)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.units import normalized_value_sql
from lakeweave.operators.joins import lookup

STATION_YEAR_KEYS = ["observation_year", "station_id", "country_id", "country_name"]


def stations(cleansed_stations: DataFrame, countries: DataFrame, states: DataFrame) -> DataFrame:
    """One row per station with country and state names (left joins, NULL when unmatched)."""
    s = lookup(cleansed_stations, countries, "country_id", "id", {"name": "country_name"})
    s = lookup(s, states, "state_id", "id", {"name": "state_name"})
    return s.select(
        "id", "country_id", "country_name", "state_id", "state_name",
        "latitude", "longitude", "elevation", "name", "gsn_flag", "hcn_crn_flag", "wmo_id",
    )


def observations(cleansed_obs: DataFrame, curated_stations: DataFrame) -> DataFrame:
    """Every observation (failed QC included) with station geography; units normalized once."""
    joined = lookup(
        cleansed_obs,
        curated_stations,
        "station_id",
        "id",
        {c: c for c in ["country_id", "country_name", "state_id", "latitude", "longitude", "elevation"]},
    )
    return joined.selectExpr(
        "observation_year", "observation_date", "observed_at", "station_id", "measure",
        "observation_value",
        f"{normalized_value_sql('measure', 'observation_value')} AS observation_value_normalized",
        "measurement_flag", "quality_flag", "source_flag",
        "country_id", "country_name", "state_id", "latitude", "longitude", "elevation",
    )


def _when(measure: str, value: str) -> str:
    return f"CASE WHEN measure = '{measure}' THEN {value} END"


def station_year_from_obt(curated_obs: DataFrame) -> DataFrame:
    """Station-year fact read from a persisted one-big-table (single partial+final agg)."""
    v = "observation_value_normalized"
    return (
        curated_obs.filter("quality_flag IS NULL")
        .groupBy(*STATION_YEAR_KEYS)
        .agg(
            F.expr(f"avg({_when('TMAX', v)}) AS avg_tmax_celsius"),
            F.expr(f"avg({_when('TMIN', v)}) AS avg_tmin_celsius"),
            F.expr(f"min({_when('TMIN', v)}) AS min_tmin_celsius"),
            F.expr(f"sum({_when('PRCP', v)}) AS total_precip_mm"),
            F.expr(f"sum({_when('SNOW', v)}) AS total_snowfall_mm"),
            F.expr("count(1) AS observation_count"),
        )
    )


def station_year(cleansed_obs: DataFrame, curated_stations: DataFrame) -> DataFrame:
    """Same result as ``station_year_from_obt(observations(...))``, planned for scale.

    The station attributes are functionally dependent on the station, so readings are
    rolled up per (year, station) *before* the dimension join: partial aggregation
    collapses even a station holding a third of all rows inside each map task, and
    the join then sees one row per station-year instead of one per reading. The
    second aggregation merges the partials per full key, so a duplicated station id
    would still count exactly as the row-level join would.
    """
    return merge_station_year(station_year_partials(cleansed_obs), curated_stations)


def station_year_partials(cleansed_obs: DataFrame) -> DataFrame:
    """Sums, counts and the minimum per (year, station) of the readings that passed QC; partials of disjoint readings add up."""
    v = normalized_value_sql("measure", "observation_value")
    return (
        cleansed_obs.filter("quality_flag IS NULL")
        .groupBy("observation_year", "station_id")
        .agg(
            F.expr(f"sum({_when('TMAX', v)}) AS tmax_sum"),
            F.expr(f"count({_when('TMAX', v)}) AS tmax_n"),
            F.expr(f"sum({_when('TMIN', v)}) AS tmin_sum"),
            F.expr(f"count({_when('TMIN', v)}) AS tmin_n"),
            F.expr(f"min({_when('TMIN', v)}) AS tmin_min"),
            F.expr(f"sum({_when('PRCP', v)}) AS prcp_sum"),
            F.expr(f"sum({_when('SNOW', v)}) AS snow_sum"),
            F.expr("count(1) AS n"),
        )
    )


def merge_station_year(partials: DataFrame, curated_stations: DataFrame) -> DataFrame:
    """The station-year fact from any number of partials per (year, station)."""
    joined = lookup(partials, curated_stations, "station_id", "id", {"country_id": "country_id", "country_name": "country_name"})
    return joined.groupBy(*STATION_YEAR_KEYS).agg(
        F.expr("CASE WHEN sum(tmax_n) > 0 THEN sum(tmax_sum) / sum(tmax_n) END AS avg_tmax_celsius"),
        F.expr("CASE WHEN sum(tmin_n) > 0 THEN sum(tmin_sum) / sum(tmin_n) END AS avg_tmin_celsius"),
        F.expr("min(tmin_min) AS min_tmin_celsius"),
        F.expr("sum(prcp_sum) AS total_precip_mm"),
        F.expr("sum(snow_sum) AS total_snowfall_mm"),
        F.expr("cast(sum(n) as bigint) AS observation_count"),
    )
